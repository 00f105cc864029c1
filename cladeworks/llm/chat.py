"""Chat formatting over prefix trees of conversations.

Template: a turn is `<|role|>`, a line feed, the text, `<|end|>` and a line feed. Strings that this or other common
templates treat as control (CONTROL) never occur inside an escaped text: a backslash after the first character breaks
them, and a backslash of the text is doubled, so unescaping is exact.

Distinct conversations are sorted by the hashes of their turns. Neighbours then share the longest prefixes, and one pass
with the path to the last leaf as its only state emits each turn that the last conversation hasn't, which is the
prefix tree depth-first. The stream is cut into blocks, the unit that a model sees: inside a block a shared turn is
written once, a tree that spans blocks repeats only the open path at the start of the next. A node has its span in the
block, the position id of its first character (the length of its path before it), and the spans of its ancestors as
merged intervals: a token attends to these and to earlier tokens of its own span. Units are code points; encode()
gives token ids for a node's text with a tokenizer file.

Equal conversations collapse before sorting (summed where they are), so a conversation that a third of the rows repeat
is one leaf; membership is a table of its own. A conversation is handled whole in one task, groups of them never are.

Defined cases: turns sort by (turn, role, text), nulls first; null role and text count as empty; rows with a null
conv_id form one conversation with a null id; repeated rows are repeated turns; extra columns are ignored; an empty
table gives empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Workspace

# Control strings of this and other public chat templates.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BLOCK_CHARS, BLOCKS_A_TASK = 1 << 20, 4
_STARTS = re.compile(r"\\|(?=" + "|".join(map(re.escape, CONTROL)) + ").", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<\|((?:[^|\\]|\\.|\|(?!>))*)\|>\n(.*?)<\|end\|>\n", re.S)
_ROLE = re.compile(r"[|\\<]")

BLOCKS = (
    "block string, text string, nodes array<struct<start: long, stop: long, position: long, parent: int, role: string, loss_start: long, loss_stop: long, "
    "attends: array<struct<start: long, stop: long>>>>, leaves array<struct<key: string, node: int>>"
)


def escape(text: str) -> str:
    return _STARTS.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def head(role: str) -> str:
    return "<|" + _ROLE.sub(lambda m: "\\" + m[0], role) + "|>\n"


TAIL = "<|end|>\n"


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, key, turns: one row a conversation, key the hash of all its turns."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(turn)), lambda t: F.struct(t.role.alias("role"), t.text.alias("text"))).alias("turns"))
    hashes = F.transform("turns", lambda t: F.sha2(F.concat(t.role, F.lit("\n"), t.text), 256))
    return whole.withColumn("path", F.concat_ws("", hashes)).withColumn("key", F.sha2("path", 256))


def build(distinct: Iterator[pd.DataFrame], block_chars: int, part: str) -> Iterator[pd.DataFrame]:
    """Blocks from conversations (key, path, turns) in order of path."""
    made, size = 0, 0
    texts: list[str] = []
    nodes: list[dict] = []
    leaves: list[dict] = []
    open_: list[tuple[str, int]] = []  # hash and node of each turn on the path to the last leaf

    def block() -> pd.DataFrame:
        return pd.DataFrame({"block": [f"{part}-{made}"], "text": ["".join(texts)], "nodes": [nodes], "leaves": [leaves]})

    for batch in distinct:
        for key, path, turns in zip(batch.key, batch.path, batch.turns):
            if size >= block_chars:
                yield block()
                made, size, texts, nodes, leaves, open_ = made + 1, 0, [], [], [], []
            steps = [path[i : i + 64] for i in range(0, len(path), 64)]
            shared = 0
            while shared < min(len(open_), len(steps)) and open_[shared][0] == steps[shared]:
                shared += 1
            del open_[shared:]
            for step, turn in zip(steps[shared:], turns[shared:]):
                begin, body = head(turn["role"]), escape(turn["text"])
                parent = open_[-1][1] if open_ else -1
                attends: list[dict] = []
                position = 0
                if parent >= 0:
                    up = nodes[parent]
                    position = up["position"] + up["stop"] - up["start"]
                    attends = [*up["attends"], {"start": up["start"], "stop": up["stop"]}]
                    if len(attends) > 1 and attends[-2]["stop"] == attends[-1]["start"]:
                        attends[-2:] = [{"start": attends[-2]["start"], "stop": attends[-1]["stop"]}]
                stop = size + len(begin) + len(body) + len(TAIL)
                loss = (size + len(begin), size + len(begin) + len(body)) if turn["role"] == "assistant" else (size, size)
                nodes.append({"start": size, "stop": stop, "position": position, "parent": parent, "role": turn["role"], "loss_start": loss[0], "loss_stop": loss[1], "attends": attends})
                texts += [begin, body, TAIL]
                size = stop
                open_.append((step, len(nodes) - 1))
            leaves.append({"key": key, "node": open_[-1][1] if open_ else -1})
    if leaves:
        yield block()


def prefix_trees(convs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Blocks (BLOCKS) of the distinct conversations of conversations()."""
    work = Workspace(convs.sparkSession, "chat")
    distinct = work.save(convs.select("key", "path", "turns").dropDuplicates(["key"]), "distinct")
    size = F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + F.length(t["text"]))
    chars = distinct.agg(F.sum(size)).first()[0] or 0
    n = 1 + chars // (BLOCKS_A_TASK * block_chars)  # cuts between tasks are rarer than those between blocks
    ordered = distinct.repartitionByRange(n, "path").sortWithinPartitions("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        return build(batches, block_chars, str(TaskContext.get().partitionId()))

    return ordered.mapInPandas(run, BLOCKS)


def visible(text: str, node: dict) -> str:
    """What a leaf's last token sees: the ancestors' spans and its own."""
    return "".join(text[a["start"] : a["stop"]] for a in node["attends"]) + text[node["start"] : node["stop"]]


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"not in the template at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def read_back(blocks: DataFrame) -> DataFrame:
    """key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each leaf, from the blocks alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, nodes, leaves in zip(batch.text, batch.nodes, batch.leaves):
                rows = []
                for leaf in leaves:
                    path, i = [], leaf["node"]
                    formatted = visible(text, nodes[i]) if i >= 0 else ""
                    while i >= 0:
                        path.append(i)
                        i = nodes[i]["parent"]
                    turns = parse(formatted)
                    lost = "".join(unescape(text[nodes[i]["loss_start"] : nodes[i]["loss_stop"]]) for i in path[::-1])
                    said = "".join(f"{role}\n{said}\n" for role, said in turns)
                    rows.append((leaf["key"], len(turns), hashlib.sha256(said.encode("utf-8", "surrogatepass")).hexdigest(), len(lost), hashlib.sha256(lost.encode("utf-8", "surrogatepass")).hexdigest(), len(formatted)))
                yield pd.DataFrame(rows, columns=["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return blocks.mapInPandas(run, "key string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def encode(blocks: DataFrame, tokenizer_path: str) -> DataFrame:
    """block, node, ids, positions: token ids of each node's text by a tokenizers file, position ids counted along its path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(tokenizer_path)
        tok.encode_special_tokens = True
        for batch in batches:
            for name, text, nodes in zip(batch.block, batch.text, batch.nodes):
                ids = [e.ids for e in tok.encode_batch([text[n["start"] : n["stop"]] for n in nodes], add_special_tokens=False)]
                begin: list[int] = []
                for i, n in enumerate(nodes):
                    begin.append(0 if n["parent"] < 0 else begin[n["parent"]] + len(ids[n["parent"]]))
                yield pd.DataFrame({"block": name, "node": range(len(nodes)), "ids": ids, "positions": [list(range(b, b + len(x))) for b, x in zip(begin, ids)]})

    return blocks.mapInPandas(run, "block string, node int, ids array<int>, positions array<int>")
