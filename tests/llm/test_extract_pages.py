"""Hand-written pages of layouts that the training pages don't generate, with the text that a reader would keep."""

from __future__ import annotations

import pytest

from cladeworks.llm import extract

ARTICLE = "<h1>On tides</h1><p>The sea rises twice a day along this coast.</p>"
KEPT = ["On tides", "The sea rises twice a day along this coast."]
INNER = {
    "form": "<form><p>sign up</p><input></form>",
    "deep form": "<form action='/s'><div><div><section><p>Your name please, and the town where you live</p></section></div></div><p>We never share it.</p></form>",
    "aside": "<aside>Related: the moon and its pull</aside>",
    "aside paragraph": "<aside><h3>See also</h3><p>Our long report about harbours in winter</p></aside>",
    "discussion": "<section id='discussion'><h2>Readers say</h2><p>I have seen it myself last summer, nice text.</p><p>Me too!</p></section>",
    "thread": "<ol class='thread'><li class='post-reply'>What a nice piece, thank you for it.</li><li class='post-reply'><p>I don't agree.</p></li></ol>",
    "comment articles": "<div class='comments'><article class='comment'><p>First of all, the sea is not that high here.</p><div class='replies'><article class='comment'><p>It is.</p></article></div></article></div>",
    "footer": "<div class='ft'>&copy; 2020 The Coast Review</div>",
    "notice": "<div class='cookie-notice'><p>We use cookies to make this site better for you.</p><button>Fine</button></div>",
    "advert": "<div class='ad-slot'>Buy two boots and pay for one</div>",
    "menu": "<ul class='menu'><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul>",
}


@pytest.mark.parametrize("name", INNER)
@pytest.mark.parametrize("place", ["inside", "after"])
def test_what_is_no_article_goes(name, place):
    inside, after = (INNER[name], "") if place == "inside" else ("", INNER[name])
    page = f"<html><body><nav><a href='/'>Home</a></nav><article>{ARTICLE}{inside}<p>At night it is the other way round.</p></article>{after}</body></html>"
    assert extract.default_model().text(page).split("\n") == [*KEPT, "At night it is the other way round."]


def test_text_of_the_body_itself_stays():
    assert extract.default_model().text("<html><body>Only words stand here, without any element around them.</body></html>") == "Only words stand here, without any element around them."
    assert extract.default_model().text("Words without any markup at all, in one line.") == "Words without any markup at all, in one line."


def test_sections_tables_and_quotes_of_the_article_stay():
    page = "<body><div id='wrap'><main><h1>Salt</h1><section><h2>Uses</h2><p>For food.</p><blockquote>As good as salt</blockquote></section><table><tr><td>Sea</td><td>35 g</td></tr></table></main><footer><p>All rights reserved</p></footer></div></body>"
    assert extract.default_model().text(page).split("\n") == ["Salt", "Uses", "For food.", "As good as salt", "Sea", "35 g"]


@pytest.mark.parametrize("shell", ["article", "main", "div"])
def test_a_form_around_the_whole_page_hides_nothing(shell):
    page = f"<body><form id='aspnetForm'><nav><a href='/'>Home</a></nav><{shell}>{ARTICLE}{INNER['form']}</{shell}></form></body>"
    assert extract.default_model().text(page).split("\n") == KEPT
