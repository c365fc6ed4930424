"""Language identification, scoring, license scans and extraction."""

import collections
import html
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from awkward import EDGES, PROSE, documents
from pyspark.sql import functions as F

from flowlark.llm import common, html_blocks, language, licenses, scoring

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# --- language ---------------------------------------------------------------------------


class PlainTrees:
    """The same code lengths, symbol by symbol."""

    def __init__(self, texts):
        self.counts = [collections.defaultdict(collections.Counter) for _ in range(4)]
        for text in texts:
            raw = b"\n\n\n" + text.lower()
            for i in range(3, len(raw)):
                for depth in range(4):
                    self.counts[depth][raw[i - depth : i]][raw[i]] += 1

    def bits(self, text):
        raw, out = b"\n\n\n" + text.lower(), 0.0
        for i in range(3, len(raw)):
            for depth in (3, 2, 1, 0, -1):
                if depth < 0:
                    out += 8.0
                    break
                seen = self.counts[depth].get(raw[i - depth : i])
                if not seen:
                    continue
                total = sum(seen.values()) + len(seen)
                if seen[raw[i]]:
                    out -= math.log2(seen[raw[i]] / total)
                    break
                out -= math.log2(len(seen) / total)
        return out


def test_code_lengths_match_plain_trees(spark):
    texts = {"en": [PROSE, "another small text"], "fr": ["une phrase", "ÉTÉ été à là"]}
    rows = [(i, t, lang, "") for i, (lang, t) in enumerate((k, t) for k, ts in texts.items() for t in ts)]
    model = language.learn(documents(spark, rows), "text", "lang")
    assert model.langs == ["en", "fr"]
    trees = [PlainTrees([t.encode() for t in texts[k]]) for k in model.langs]
    asked = ["A quiet été", "", "zzz \U0001f600 zzz", PROSE * 2, "e"]
    got = model.code_lengths(*common.text_bytes(pa.array(asked)))
    want = [[tree.bits(t.encode()) for tree in trees] for t in asked]
    assert np.allclose(got, want, rtol=1e-5)


def test_language_edges(edges):
    model = language.learn(edges, "text", "lang")
    rows = language.predict(edges, model, "text", [F.col("doc_id"), F.col("text")]).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        if any(map(str.isalpha, r["text"] or "")):
            assert r["lang_pred"] in model.langs and 0 < r["score"] <= 1
        else:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    # Trees are told apart by the texts they saw.
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 12)} == {"en"}


@pytest.mark.parametrize("held", [0, 40, 150])
def test_language_beyond_the_broadcast(spark, held):
    """With few windows held, the others are joined: predictions stay, no language is lost."""
    draw = random.Random(4)
    small = ["kvik zorn mjuk", "zorn kvik", "mjuk zorn zorn"]
    asked = [*small, "A quiet été", "", "12 !", None, "zzz \U0001f600 zzz kvik", PROSE, "éÉ 中文 İ"]
    rows = [(i, PROSE[draw.randrange(60) :], "en", "") for i in range(40)]
    rows += [(100 + i, t, "sm", "") for i, t in enumerate(small)]
    rows += [(200, "une phrase ÉTÉ été à là, 中文 中文字", "fr", "")]
    lessons = documents(spark, rows)
    df = documents(spark, [(i, t, "", "") for i, t in enumerate(asked)])
    whole = language.learn(lessons, "text", "lang")
    part = language.learn(lessons, "text", "lang", max_windows=held)
    assert part.langs == whole.langs == ["en", "fr", "sm"]
    assert whole.whole and not part.whole
    want, got = (
        {r["doc_id"]: r for r in language.predict(df, m, "text", [F.col("doc_id")]).collect()} for m in (whole, part)
    )
    assert len(got) == len(asked)
    for i, r in want.items():
        assert got[i]["lang_pred"] == r["lang_pred"]
        assert got[i]["score"] == pytest.approx(r["score"], rel=1e-4)
    assert {got[i]["lang_pred"] for i in range(3)} == {"sm"}


def test_language_without_lessons(spark, nothing):
    model = language.learn(nothing, "text", "lang")
    assert language.predict(nothing, model, "text", [F.col("doc_id")]).count() == 0
    df = documents(spark, [(1, PROSE, None, "")])
    got = language.predict(df, language.learn(df, "text", "lang"), "text", [F.col("doc_id")]).first()
    assert (got["lang_pred"], got["score"]) == ("und", 0.0)


# --- scoring ----------------------------------------------------------------------------


def _tokens(text):
    return [*WORD.findall((text or "").encode().lower()), None]


@pytest.mark.parametrize("known", [3, scoring.KNOWN])
def test_base_score(spark, monkeypatch, known):
    """Counts of words beyond the broadcast ones come from the join."""
    monkeypatch.setattr(scoring, "KNOWN", known)
    rows = [*EDGES, (20, "quiet unseen words and boats", "en", "a")]
    df = documents(spark, rows)
    lesson = F.coalesce(F.col("doc_id") < 11, F.lit(True))
    taught = [r for r in rows if r[0] is None or r[0] < 11]
    counts = collections.Counter(t for r in taught for t in _tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    got = scoring.score_documents(df, lesson, carry=[F.col("doc_id"), F.col("text")]).collect()
    assert len(got) == len(rows)
    for r in got:
        tokens = _tokens(r["text"])
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert r["n_tokens"] == len(tokens) and r["train_tokens"] == n
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0


def _trained(spark, texts):
    df = documents(spark, [(i, t, "", "") for i, t in enumerate(texts)])
    model, _ = scoring.vocabulary(df, "text")
    return scoring.train(df, "text", model)


def test_probabilities_are_normalised(spark):
    model = _trained(spark, [PROSE] * 30)
    scorer = scoring.Scorer(model)
    every = np.arange(model.size)
    for one, two in ((model.size, model.size), (3, model.size), (1, 5)):
        logs = scorer.class_scores(every, np.full(model.size, one), np.full(model.size, two))
        assert np.exp(logs).sum() == pytest.approx(1, rel=1e-3)
    # Shares of an ending: its known words and one more.
    total = model.share.sum(axis=1) + 1
    assert ((model.share[:, 0] + model.share[:, 1] + 1) / total == 1).all()


def test_most_frequent_is_bounded(spark):
    draw = random.Random(8)
    rows = [(i, int(draw.paretovariate(0.7))) for i in range(3000)]
    df = spark.createDataFrame(rows, "w long, n long")
    for limit in (0, 10, 500, 5000):
        got = {r["w"]: r["n"] for r in common.most_frequent(df, "n", limit).collect()}
        assert len(got) <= limit
        rest = [n for w, n in rows if w not in got]
        assert not got or not rest or min(got.values()) >= max(rest)
    assert len(got) == 3000


def test_model_learns_context(spark):
    draw = random.Random(1)
    texts = []
    for _ in range(900):
        words = draw.choice([["a", "b", "c", "d", "e"], ["v", "w", "x", "y", "z"]])
        texts.append(" ".join(draw.choice(words) for _ in range(40)))
    df = documents(spark, [(i, t, "", "") for i, t in enumerate(texts)]).repartition(2)
    got = scoring.score_documents(df, F.col("doc_id") % 5 != 0, carry=[F.col("doc_id")])
    held = got.filter("doc_id % 5 = 0").agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > 0.9 * held[0]
    again = scoring.score_documents(df, F.col("doc_id") % 5 != 0, carry=[F.col("doc_id")])
    first = {r["doc_id"]: r["score"] for r in got.collect()}
    assert all(abs(r["score"] - first[r["doc_id"]]) < 1e-3 * abs(r["score"]) for r in again.collect())


def test_rounds_learn_across_tasks(spark):
    """Tasks with few texts each still reach a trained model, from each other's mean."""
    draw = random.Random(1)
    sides = [["a", "b", "c", "d", "e"], ["v", "w", "x", "y", "z"]]
    texts = [" ".join(draw.choices(draw.choice(sides), k=40)) for _ in range(900)]
    df = documents(spark, [(i, t, "", "") for i, t in enumerate(texts)]).repartition(12)
    got = scoring.score_documents(df, F.col("doc_id") % 5 != 0, carry=[F.col("doc_id")])
    held = got.filter("doc_id % 5 = 0").agg(F.sum("base_score"), F.sum("score")).first()
    assert held[1] > 0.9 * held[0]


def test_scoring_without_lessons(spark, nothing):
    assert scoring.score_documents(nothing, F.lit(True), carry=[F.col("doc_id")]).count() == 0
    df = documents(spark, [(1, "a b", "", ""), (2, None, "", "")])
    rows = scoring.score_documents(df, F.lit(False), carry=[F.col("doc_id")]).collect()
    assert {r["train_tokens"] for r in rows} == {0} and {r["n_known"] for r in rows} == {0}
    assert all(r["base_score"] == 0 and r["score"] < 0 for r in rows)


# --- licenses ---------------------------------------------------------------------------


def _plain_places(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    out = []
    for label, phrase in licenses.PHRASES:
        asked = phrase.encode().split()
        out += [(label, i) for i in range(len(words)) if words[i : i + len(asked)] == asked]
    return len(words), sorted(out)


def test_license_places(spark):
    draw = random.Random(5)
    bits = "gnu general public license apache cc by mit the of x GPL, MIT. \n Ümit".split(" ")
    texts = [" ".join(draw.choice(bits) for _ in range(draw.randrange(40))) for _ in range(300)]
    df = documents(spark, [*EDGES, *[(100 + i, t, "", "") for i, t in enumerate(texts)]])
    found = licenses.scan_licenses(df.withColumn("id2", F.struct("doc_id", "text")), "id2").collect()
    assert len(found) == len(EDGES) + len(texts)
    for r in found:
        n, places = _plain_places(r["id"]["text"])
        assert r["n_words"] == n
        assert sorted((p["label"], p["first_word"]) for p in r["places"]) == places


def test_license_notices(spark):
    notice = dict(licenses.NOTICES)["bsd-notice"]
    words = notice.split()
    texts = {
        1: f"Some code.\n{notice.upper()}: and more", 2: " ".join(words[:9] + ["really"] + words[9:]),
        3: " ".join(words[: len(words) // 3]), 4: PROSE, 5: " ".join(sorted(words)),
        6: "Licensed under the Apache License, Version 2.0.",
    }
    df = documents(spark, [(i, t, "", "") for i, t in texts.items()])
    got = {r["id"]: {s["label"] for s in r["spans"]} for r in licenses.scan_licenses(df).collect()}
    assert got == {1: {"bsd-notice"}, 2: {"bsd-notice"}, 3: set(), 4: set(), 5: set(), 6: {"apache-2.0"}}


VARIANTS = {
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
    "Public License as published by the Free Software Foundation, either version 3.": {"agpl-notice"},
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation.": {"lgpl-notice"},
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation.": {"gpl-notice"},
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": {"cc-by-4.0"},
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": {"cc-by-sa-4.0"},
    "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.": {"cc-by-nc-nd-4.0"},
    "It was not licensed under the Apache License, Version 2.0, at all.": set(),
    "Licensed under the Apache License, Version 2.0 (the License);": {"apache-2.0"},
    "# SPDX-License-Identifier: GPL-3.0-or-later": {"spdx:gpl-3.0-or-later"},
    "// SPDX-License-Identifier: MIT": {"spdx:mit"},
    "SPDX-License-Identifier: Something-Else": set(),
    "Not licensed under the Apache License, Version 2.0. SPDX-License-Identifier: ISC, this work is licensed under a "
    "Creative Commons Attribution-NonCommercial 4.0 International License.": {"spdx:isc", "cc-by-nc-4.0"},
}


def test_license_variants(spark):
    """Words in which variants differ decide between templates over the same place."""
    rows = [(i, PROSE + " " + text + " " + PROSE, None, None) for i, text in enumerate(VARIANTS)]
    both = " ".join(VARIANTS)
    rows.append((100, both, None, None))
    got = {r["id"]: {s["label"] for s in r["spans"]} for r in licenses.scan_licenses(documents(spark, rows)).collect()}
    assert got.pop(100) == set().union(*VARIANTS.values())
    assert got == dict(enumerate(VARIANTS.values()))


def test_license_empty(nothing):
    assert licenses.scan_licenses(nothing).count() == 0


# --- extraction -------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<header class="site-header"><a href="/">The Daily</a></header>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- <p>hidden</p> -->
<div class="cookie-notice">We use cookies. <button>Accept</button></div>
<article><h1>Caf&eacute; &amp; bar</h1><p>One <b>bold</b>
 word&#33;<p>Second&nbsp;line<br>goes on.<div class="ad">Buy now</div><p>Last &lt;p&gt; line.</article>
<section class="comments"><div class="comment"><p>Great!</p></div></section>
<form class="newsletter"><label>Your email</label><input></form><footer>&copy; all rights</footer>"""


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, _html long")


def test_extraction(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<p <<>> &"), (None, "u", PAGE), (1, "u", PAGE)]
    got = html_blocks.extract_text(_pages(spark, rows)).select("page_id", "url", "text", "n_chars").collect()
    assert len(got) == len(rows)
    want = "Café & bar One bold word! Second line goes on. Last <p> line."
    texts = sorted(((r["page_id"], r["text"]) for r in got), key=repr)
    assert [t for i, t in texts if i in (1, None)] == [want] * 3
    assert {t for i, t in texts if i in (2, 3)} == {""}
    assert all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article><h1>T</h1><svg class="i"/><p>All of it.</p></article>', ["T", "All of it."]),
        ("<article><p>One<svg><path d='M0'><text>x</text></svg> two.</p></article>", ["One two."]),
        ("<article><p>One.</p><svg><path d='M0'/><p>Two.</p></article><p>Three.</p>", ["One.", "Two.", "Three."]),
        ("<div><p>One.</p><noscript><p>no</p></div><p>Two.</p><noscript>no</noscript>", ["One.", "Two."]),
        ("<div><object data=x><p>no</div><p>Two.</p>", ["Two."]),
        ("<p>One <span><iframe>no</span>two.</p>", ["One two."]),
        ("<div><svg><foreignObject><p>no</p></foreignObject><svg></svg>no</svg><p>Two.</p></div>", ["Two."]),
        ("<div><p>One.</p><script>no</div><p>no</p>", ["One."]),
    ],
)
def test_elements_without_text(page, want):
    assert html_blocks.blocks(page).texts == want


def test_extraction_of_drawn_pages():
    draw = np.random.default_rng(77)
    pages = [html_blocks.blocks(html_blocks.draw_page(draw)) for _ in range(200)]
    kept = html_blocks.kept_blocks(html_blocks.trained(), pages)
    wrong = sum(int((k != np.array(p.labels, bool)).sum()) for k, p in zip(kept, pages))
    assert wrong < 0.01 * sum(len(p.texts) for p in pages)


def test_extraction_of_given_pages(spark):
    """All pages of the small table, where the article is marked."""
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html_blocks.extract_text(table).collect()}
    for r in table.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        body = re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", body))
        assert got[r["page_id"]] == " ".join(html.unescape(body).split())


def test_recurrent_gradients():
    """Gradients by differences."""
    draw = np.random.default_rng(2)
    pages = [html_blocks.blocks(html_blocks.draw_page(draw)) for _ in range(3)]
    p = {k: v.astype(np.float64) for k, v in html_blocks._start().items()}
    grad = html_blocks._gradients(p, pages)

    def loss():
        x, mask = html_blocks._padded(html_blocks._inputs(p, html_blocks.vectors(pages)), [len(g.texts) for g in pages])
        scores = html_blocks._scores(p, x, mask)
        out = 0.0
        for i, g in enumerate(pages):
            s, y = scores[: len(g.texts), i].astype(float), np.array(g.labels)
            out += (np.logaddexp(0, s) - y * s).sum()
        return out / len(pages)

    for name in ("fx", "bh", "fb", "out", "direct"):
        flat, at = p[name].ravel(), int(np.abs(grad[name]).argmax())
        kept, step = flat[at], 1e-2
        flat[at] = kept + step
        up = loss()
        flat[at] = kept - step
        down = loss()
        flat[at] = kept
        assert (up - down) / (2 * step) == pytest.approx(grad[name].ravel()[at], rel=0.05)


def test_extraction_empty(spark):
    assert html_blocks.extract_text(_pages(spark, [])).count() == 0


# --- pages whose main text has no telling element ------------------------------------------

STORY = [
    "The committee met on Tuesday to discuss the new budget, and several members asked for more time to read it.",
    "Local residents said that the changes would make the streets safer, although some of them doubted the cost.",
    "A final vote is expected next month, after the finance office has answered the questions that were raised.",
]
BERICHT = [
    "Der Ausschuss hat am Dienstag über den neuen Haushalt beraten, und mehrere Mitglieder baten um mehr Zeit.",
    "Die Anwohner sagten, dass die Straßen dadurch sicherer würden, auch wenn einige an den Kosten zweifelten.",
]
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/a">About us</a></li><li><a href="/c">Contact</a></li></ul>'
FOOT = "<p>Copyright 2021 Example Ltd. All rights reserved.</p>"
PARAGRAPHS = "".join(f"<p>{x}</p>" for x in STORY)
LAYOUTS = {
    "bare": (f"{MENU}<h1>Budget talks go on</h1>{PARAGRAPHS}{FOOT}", STORY),
    "nothing else": (PARAGRAPHS, STORY),
    "plain divs": (f"<div>{MENU}</div><div><div><h1>Budget talks</h1>{''.join(f'<div>{x}</div>' for x in STORY)}</div></div><div>{FOOT}</div>", STORY),
    "hashed names": (f"<div class='css-1ab'>{MENU}</div><div class='css-9z'><h1>Budget talks</h1>{PARAGRAPHS}</div><div class='css-77'>{FOOT}</div>", STORY),
    "deep hashed names": (f"<div class=a1><div class=q7x><div class=zz2>{MENU}</div><div class=m0k><div class=p9>{PARAGRAPHS}</div></div></div></div>", STORY),
    "table": (f"<table><tr><td><a href='/'>Home</a><br><a href='/n'>News</a><br><a href='/a'>About us</a></td><td><h1>Budget talks</h1>{PARAGRAPHS}</td></tr><tr><td>{FOOT}</td></tr></table>", STORY),
    "one text": (" ".join(STORY), STORY),
    "line breaks": ("<br><br>".join(STORY), STORY),
    "other language": (f"<div>{MENU}</div><div><h1>Haushalt</h1>{''.join(f'<p>{x}</p>' for x in BERICHT)}</div><div>{FOOT}</div>", BERICHT),
    "links in the article": (f"<nav>{MENU}</nav><article><p>{STORY[0]}</p><ul><li><a href='/x'>The budget report of the town</a></li><li><a href='/y'>Minutes of the last meeting</a></li></ul><p>{STORY[1]}</p></article><footer>{FOOT}</footer>",
                             [STORY[0], "The budget report of the town", "Minutes of the last meeting", STORY[1]]),
}


@pytest.mark.parametrize("name", list(LAYOUTS))
def test_layouts_outside_the_grammar(name):
    body, story = LAYOUTS[name]
    page = html_blocks.blocks(f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}</body></html>")
    kept = html_blocks.kept_blocks(html_blocks.trained(), [page])[0]
    text = " ".join(t for t, k in zip(page.texts, kept) if k)
    for part in story:
        assert part in text
    for part in ("Home", "News", "About us", "All rights"):
        assert part not in text
