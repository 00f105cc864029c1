"""External programs behind one gate: run where installed, an explicit 'not_measurable' with the reason where not. Results are never invented."""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Programs and their time limits in seconds.
TIMEOUTS = {"hmmsearch": 600, "mafft": 600, "trimal": 300, "FastTree": 600, "iqtree2": 3600, "astral": 1800, "checkm": 3600}
SCHEMA = "key string, state string, reason string, output string"


def missing(programs: list[str]) -> list[str]:
    return [p for p in programs if shutil.which(p) is None]


def run_tool(inputs: DataFrame, program: str, command: Callable[[str], list[str]]) -> DataFrame:
    """SCHEMA for each input (key, text): the program's output for text on its standard input.

    One process a row, in whichever task holds it; a failure or a time-out is a state, except that callers who need
    the tool may ask missing() first and refuse.
    """
    limit = TIMEOUTS.get(program, 600)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        there = shutil.which(program) is not None
        for batch in batches:
            rows = []
            for key, text in zip(batch.key, batch.text):
                if not there:
                    rows.append((key, "not_measurable", f"{program} is not installed", None))
                    continue
                try:
                    done = subprocess.run(command(key), input=text, capture_output=True, text=True, timeout=limit, check=False)
                    ok = done.returncode == 0
                    rows.append((key, "measured" if ok else "not_measurable", None if ok else f"exit {done.returncode}: {done.stderr[-200:]}", done.stdout if ok else None))
                except subprocess.TimeoutExpired:
                    rows.append((key, "not_measurable", f"no result in {limit} s", None))
            yield pd.DataFrame(rows, columns=["key", "state", "reason", "output"])

    return inputs.select("key", "text").mapInPandas(run, SCHEMA)
