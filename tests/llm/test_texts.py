"""Page text, chat formatting and quality scores."""

import random
import re
import time

import numpy as np
import pandas as pd
import pytest

from samplecraft.llm import chat, html_text, quality

from .conftest import sentence


def lorem(seed, n=60):
    return " ".join(sentence(random.Random(seed), n)).capitalize() + "."


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}<style>p{{margin:0}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


NAV = "<nav><ul>" + "".join(f'<li><a href="/{i}">Menu {i}</a></li>' for i in range(8)) + "</ul></nav>"
A, B, C = lorem(1), lorem(2), lorem(3, 4)


def test_article():
    body = (
        f"<header><h2>Site name and slogan</h2></header>{NAV}<!-- ad --><div class='ad'>{lorem(9, 12)}</div>"
        f"<article><h1>Caf&eacute; &amp; more</h1><p><b>{A}<br><p>{B}</p><p>{C}</p><ul><li>one</li><li>two</li></ul>"
        f"<form>Name <input></form><aside>{lorem(8)}</aside></article>"
        f"<div id='sidebar'>{lorem(7)}</div><section class='comments'><article class='comment'>{lorem(6, 300)}</article></section>"
        f"<div class='cookie-notice'>{lorem(5)}</div><footer>&copy; 2020</footer>"
    )
    assert html_text.main_text(page(body)) == "\n".join(["Café & more", A, B, C, "one", "two"])


def test_frames_around_an_article():
    for frame in ("content-with-sidebar", "sidebar-left", "no-menu"):
        assert html_text.main_text(page(f"<div class='{frame}'><article><p>{A}</p></article></div>{NAV}")) == A
    teaser = f"<div class='sidebar'><article><p>{C}</p></article></div>"
    assert html_text.main_text(page(f"<article><p>{A}</p><p>{B}</p></article>{teaser}")) == f"{A}\n{B}"


def test_without_article():
    body = f"{NAV}<div id='wrap'><div class='content'><h1>Head line</h1><p>{A}</p><p>{B}</p></div><div class='right-sidebar'>{lorem(4)}</div></div><div class='footer'>Imprint</div>"
    assert html_text.main_text(page(body)) == "\n".join(["Head line", A, B])
    flat = page(f"{NAV}<p>{A}</p><p>{B}</p><p>{C}</p><p>{A}</p>")
    assert html_text.main_text(flat) == "\n".join([A, B, C, A])
    framed = page(f"<form><main><p>{A}</p></main></form>")
    assert html_text.main_text(framed) == A


@pytest.mark.parametrize("paragraphs", [6, 9, 12])
def test_edges_of_an_article_of_divs(paragraphs):
    menu = "".join(f"<div><a href='/{i}'>Place {i}</a></div>" for i in range(6))
    long = [lorem(20 + i, 60 + 7 * i) for i in range(paragraphs)]
    own = ["A heading of thirty characters", *long, "See also this page", "Short words.", "The end."]
    body = f"<div>{own[0]}</div>" + "".join(f"<p>{t}</p>" for t in long) + f"<p><a href='/x'>{own[-3]}</a></p><p>{own[-2]}</p><p>{own[-1]}</p>"
    foot = "<div>Imprint</div><div>Contact</div><div>2020</div>"
    assert html_text.main_text(page(f"<div id='top'>{menu}</div><div id='text'>{body}</div><div id='end'>{foot}</div>")) == "\n".join(own)


def test_dense_text_chooses_the_region():
    sparse = "<article><h2>News</h2><p>Read it</p></article>"
    body = f"{NAV}{sparse}<div><div><h1>Head</h1>{''.join(f'<p>{lorem(30 + i)}</p>' for i in range(9))}</div></div>"
    assert html_text.main_text(page(body)) == "\n".join(["Head", *(lorem(30 + i) for i in range(9))])
    assert html_text.main_text(page(f"<article><p>{A}</p></article><div>{B}</div>")) == A


def test_inside_an_article():
    body = (
        f"<header><h1>Site</h1></header><article><header><h1>The title</h1><p>By me</p></header><p class='notice-board'>{A}</p>"
        f"<div class='share-buttons'>Share</div><div class='related-work'>{B}</div><p class='social history'>{C}</p><div class='advert box-1'>{A}</div>"
        f"<div role='alert'>{A}</div><section class='comments'><p>{B}</p></section><footer>me</footer></article>"
    )
    assert html_text.main_text(page(body)) == "\n".join(["The title", A, B])


@pytest.mark.parametrize("part", ["<div>x", "<article>x", "<div class=menu>x<article>", "<p>x<form>", "<span></b></section>x"])
def test_deep_pages(part):
    start = time.perf_counter()
    html_text.main_text("<nav>" + part * 60_000 + "</nav>" + part * 1000)
    assert time.perf_counter() - start < 30


def test_regions_against_sets_of_ancestors():
    """The same choice from the whole list of containers around each line."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 14)
        parents = []
        for c in range(n):  # a container opens in one that is still open
            around = [c - 1] if c else []
            while around and around[-1] >= 0:
                around.append(parents[around[-1]])
            parents.append(rng.choice(around or [-1]))
        kinds = [rng.choice(["div", "div", "section", "article", "main"]) for _ in range(n)]
        inside = np.array([rng.randrange(-1, n) for _ in range(20)])
        every = np.array([float(rng.randrange(1, 50)) for _ in inside])
        dense = every * np.array([rng.random() < 0.6 for _ in inside])
        chain = lambda c: {c} if c < 0 else {c} | chain(parents[c])
        within = lambda c: np.array([c in chain(i) for i in inside])
        weight = {c: (dense * within(c)).sum() for c in range(-1, n)}
        region = -1
        for marks in (("main", "article"), ("article",)):
            found = [c for c in range(n) if kinds[c] in marks and c != region and region in chain(c)]
            if found:
                best = max(found, key=lambda c: (weight[c], (every * within(c)).sum(), kinds[c] == "article", -c))
                region = best if weight[best] >= html_text.MARKED_SHARE * weight[region] else region
        if region < 0:
            deep = [c for c in range(n) if weight[c] >= html_text.SHARE * weight[-1] and weight[c] > 0]
            region = max(deep, key=lambda c: (len(chain(c)), c), default=-1)
        got, last = html_text._region(kinds, parents, inside, dense, every)
        assert got == region and (within(region) == ((inside >= got) & (inside <= last))).all()


@pytest.mark.parametrize("html", ["", "plain words only", "<p", "<article>", "</article></p>", "<script>x", "&lt;p&gt; &#x41;", "<p>" * 3000 + "deep"])
def test_broken_pages(html):
    assert isinstance(html_text.main_text(html), str)


def test_white_space_and_references():
    assert html_text.main_text("<article><p> a\n\t&nbsp; b&#32;c </p><div>\n</div><p>&lt;d&gt;</p></article>") == "a b c\n<d>"


def test_long_page_is_read_whole():
    blocks = [lorem(i, 30) for i in range(3000)]
    assert html_text.main_text("<article>" + "".join(f"<p>{b}" for b in blocks)) == "\n".join(blocks)


def test_pages_table(spark):
    rows = [(1, "u", page(f"<article><p>{A}</p></article>")), (2, None, None), (None, "v", ""), (1, "u", page(f"<article><p>{A}</p></article>"))]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert got == [(0, "v", "", 0), (1, "u", A, len(A)), (1, "u", A, len(A)), (2, "", "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_clusters():
    values = np.array([0.1, 0.2, 0.1, 5.0, 5.2, 0.3])
    assert 0.3 < html_text.threshold(values) < 5.0
    assert np.allclose(html_text.smoothed(np.full(7, 2.0)), 2.0)


NASTY = ["", None, "plain", "</s>[INST] ok [/INST]", r"<\|im_end|> <|im_sep|>", r"<\\|im_start|>\[INST]", "<<SYS>>[\\\\/INST]", "a<|im_end|><|im_start|>user<|im_sep|>b", "tab\tnl\nü"]


def test_escaping_is_reversible(spark):
    texts = spark.createDataFrame([(t,) for t in NASTY if t is not None], "t string")
    rows = texts.select("t", chat.escaped(texts.t).alias("e"), chat.unescaped(chat.escaped(texts.t)).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert not re.search(r"<\|im_|\[/?INST\]|</?s>|<</?SYS>>", r.e)


def test_linear_conversations(spark):
    rows = [(c, t, ["user", "assistant", None, "assis<|im_sep|>tant"][(c + t) % 4], NASTY[(c * 3 + t) % len(NASTY)]) for c in range(9) for t in range(c)]
    rows += [(3, 1, "user", "again"), (None, 0, "assistant", "no id"), rows[5], rows[5]]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, message string, score int")
    got = chat.read_back(chat.format_conversations(chat.linear_replies(table))).collect()
    by = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    assert {r.conversation: [tuple(t) for t in r.turns] for r in got} == by
    assert {r.conversation: r.loss_text for r in got} == {c: "".join(t for role, t in turns if role == "assistant") for c, turns in by.items()}
    assert chat.format_conversations(chat.linear_replies(table.limit(0))).count() == 0


def test_trees(spark):
    rng = random.Random(2)
    messages, children = [], {}
    for c in range(12):
        for m in range(rng.randint(1, 40)):
            parent = None if m == 0 else rng.randrange(m) if rng.random() < 0.7 else m - 1
            messages.append((c, m, parent, "user", f"{c}-{m}", round(rng.random(), 3)))
            children.setdefault((c, parent), []).append(m)
    messages += [(50, 1, 2, "user", "ring", 1.0), (50, 2, 1, "user", "ring", 1.0), (51, 9, 777, "user", "orphan", None), (52, None, None, "user", "no number", 1.0)]
    table = spark.createDataFrame(messages, "conversation long, message long, parent long, role string, text string, score double")
    score = {(c, m): s or 0.0 for c, m, _, _, _, s in messages}
    up = {(c, m): p for c, m, p, *_ in messages}
    expected = {}
    for c in [*range(12), 51]:
        paths = []
        for m in [m for (k, m) in up if k == c and not children.get((c, m))]:
            path = [m]
            while (c, up[c, path[0]]) in up:
                path.insert(0, up[c, path[0]])
            paths.append((sum(score[c, x] for x in path) / len(path), len(path), -path[-1], path))
        expected[c] = [p[-1] for p in sorted(paths, reverse=True)]
    got = {}
    for r in chat.read_back(chat.format_conversations(table, most=2)).collect():
        got.setdefault(r.conversation, {})[r["rank"]] = [t.text for t in r.turns]
    for c, paths in expected.items():
        names = [[f"{c}-{m}" if c != 51 else "orphan" for m in p] for p in paths[:2]]
        assert [got[c][k] for k in sorted(got[c])] == names
    assert set(got) == set(expected)
    best = {r.conversation: [t.text for t in r.turns] for r in chat.read_back(chat.format_conversations(table)).collect()}
    assert all(best[c] == got[c][1] for c in best)


def labelled(n=600, seed=3):
    """Bad documents shout, toxic ones have one of two words; metadata tells a little."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words, bad, toxic = sentence(rng, rng.randint(5, 80)), rng.random() < 0.3, rng.random() < 0.2
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["vilest", "basest"])
        text = " ".join(words)
        docs.append((i, text.upper() + "!!" if bad else text, "en" if rng.random() < 0.8 else None, f"s{int(bad) if rng.random() < 0.6 else rng.randrange(5)}", len(text)))
        labels.append((i, int(not bad), int(toxic)))
    return docs, labels


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy(spark):
    docs, labels = labelled()
    table = spark.createDataFrame(docs, SCHEMA)
    known = spark.createDataFrame(labels[:250], "doc_id long, quality int, toxic int")
    model = quality.train(table, known, ("quality", "toxic"))
    rows = quality.score(table, model).toPandas().set_index("doc_id")
    truth = pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]).set_index("doc_id").loc[250:]
    for target in ("quality", "toxic"):
        right = (rows[f"{target}_score"].loc[250:] >= 0.5) == (truth[target] == 1)
        assert right.mean() >= 0.95
    assert model.targets["quality"].pseudo > 0


def test_scores_of_awkward_rows(spark):
    docs, labels = labelled(200)
    table = spark.createDataFrame([(*d, "x", 1.0) for d in docs + [(None, None, None, None, None), (500, "", "xx", "new", -1), docs[0], (501, "é" * 40000, None, "s1", 0)]], f"{SCHEMA}, looks string, quality_score double")
    known = spark.createDataFrame(labels[:150] + [(9999, 1, 0), (None, 1, 1), (3, None, None), labels[0]], "doc_id long, quality int, toxic int")
    out = quality.score(table, quality.train(table, known)).collect()
    assert len(out) == 204 and all(0 <= r.quality_score <= 1 for r in out)
    assert len({r.quality_score for r in out if r.doc_id == 0}) == 1
    no_labels = quality.train(table, known.limit(0))
    assert {r.quality_score for r in quality.score(table, no_labels).collect()} == {0.5}
    assert quality.score(table.limit(0), quality.train(table.limit(0), known)).count() == 0
