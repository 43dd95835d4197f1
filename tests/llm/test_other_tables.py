"""Operators on vectors, pages and conversations against brute force."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimworks.llm import chat_format, html_extract, queries, vector_search

# --- vectors ------------------------------------------------------------------------


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], float)
    for q in np.flatnonzero(ids % 20 == 0):
        scores = np.einsum("ij,j->i", points, points[q])
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:k]
        for rank, j in enumerate(order, 1):
            yield int(ids[q]), rank, int(ids[j]), scores[j]


@pytest.mark.parametrize("shard_rows, query_rows", [(8192, 8192), (300, 10)])
def test_exact_search(spark, shard_rows, query_rows):
    random = np.random.default_rng(5)
    points = random.normal(size=(900, 8)) * random.uniform(0.2, 3, (900, 1))
    points[100:400] = points[100]  # ties
    rows = [(k, points[k].tolist()) for k in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    found = vector_search.nearest(frame, F.col("vec_id") % 20 == 0, 20, 1.0, shard_rows, query_rows)
    expected = list(brute(rows, 20))
    got = sorted(map(tuple, found.collect()))
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], rtol=1e-12)


def test_recall_of_the_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = {e[:3:2] for e in brute(rows, 20)}
    found = {(r.query_id, r.vec_id) for r in queries.op1_vector_search(spark, sf_dir).collect()}
    assert len(found & expected) >= 0.95 * len(expected)


def test_the_tree_prunes_at_the_querys_factor(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    points = np.array([r.embedding for r in vectors], float)
    asking = np.flatnonzero([r.vec_id % 20 == 0 for r in vectors])
    tree = vector_search.Tree(points)
    exact, relaxed = (vector_search.Search(tree, points[asking], asking, 20, f) for f in (1.0, queries.PRUNING))
    found = sum(len(set(a) & set(b)) for a, b in zip(exact.best.tolist(), relaxed.best.tolist()))
    assert relaxed.share < 0.97 and found >= 0.9 * exact.best.size
    # vectors near a few centres are what such trees are for
    random = np.random.default_rng(2)
    close = np.repeat(random.normal(size=(40, 16)), 100, axis=0) + 0.05 * random.normal(size=(4000, 16))
    tree, asking = vector_search.Tree(close), np.arange(0, 4000, 20)
    exact = vector_search.Search(tree, close[asking], asking, 20, 1.0)
    scores = close[asking] @ close.T
    scores[np.arange(len(asking)), asking] = -np.inf
    assert np.allclose(exact.score, -np.sort(-scores, axis=1)[:, :20])
    assert exact.share < 0.3


def test_rows_that_share_an_id_ask_each(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (3, [0.5, 0.25])]
    found = vector_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 2)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    assert got == sorted([
        (20, 1, 3, 0.5), (20, 2, 20, 0.0), (20, 1, 20, 1.0), (20, 2, 3, 0.25), (20, 1, 20, 1.0), (20, 2, 3, 0.25),
    ])


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (20, [0.0, 0.0]), (1, [0.5, 0.5]), (8, []),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_search.nearest(frame, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, found.collect())) == [(0, 1, 1, 0.5), (0, 2, 1, 0.5)]
    assert vector_search.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# --- pages --------------------------------------------------------------------------

PAGE = """<html><head><title>Title here</title><script>var a = "</p>";</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li>Home</li><li>More</li></ul></nav>
<div class="cookie-notice">We use cookies a lot, more words than anything else has on this page here</div>
<article><h1>Head</h1><p>One <b>bo</b>ld &amp; two&nbsp;words.<p>Open\n  paragraph<br>line
<div class="ad">Buy this now</div><form>mail <input></form><!-- gone --><p>Last.</p>
<section class="comments"><p>First!</p></section></article><footer>&copy; all</footer></body></html>"""
TEXT = "Head One bold & two words. Open paragraph line Last."


def test_main_text(spark):
    rows = [(0, "u", PAGE), (1, "u", None), (2, None, ""), (3, "u", "<p></p>"), (4, "u", PAGE[:-40]), (0, "u", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    found = html_extract.extract_pages(pages).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in found) == sorted(
        (k, t, len(t)) for k, t in [(0, TEXT), (0, TEXT), (1, ""), (2, ""), (3, ""), (4, TEXT)]
    )
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_page_without_marked_content():
    page = PAGE.replace("article>", "div>")
    learned = html_extract.weights_from(html_extract.labelled_counts(PAGE))
    assert html_extract.extract(page, learned) == html_extract.extract(page, {}) == TEXT


@pytest.mark.parametrize(
    "wrapper",
    [
        "div class='content has-sidebar'", "div class='site-content no-comments'", "div id='page-header-fixed'",
        "div class='sidebar'", "div id='header' class='ad'", "div role='banner'", "div aria-hidden='true'",
        "div data-id='ad' data-role='alert'", "div data-x=' hidden '", "form action='/'", "div title=\"a > class='ad'\"",
    ],
)
def test_wrappers_of_the_content_stay(wrapper):
    page = PAGE.replace("<article>", f"<{wrapper}><div class='menu main-menu'>Home</div><article>")
    page = page.replace("</article>", f"</article></{wrapper.split()[0]}>")
    learned = html_extract.weights_from(html_extract.labelled_counts(page))
    assert html_extract.extract(page, learned) == html_extract.extract(page, {}) == TEXT


@pytest.mark.parametrize(
    "part",
    [
        "h2 id='related-work'", "h2 class='header'", "section id='social-and-legal-history'", "section id='comments'",
        "p id='notice'", "div class='section' id='legal'", "div data-id='ad'", "div class='no-sidebar'", "p data-hidden",
    ],
)
def test_parts_named_by_their_title_stay(part):
    name = part.split()[0]
    page = PAGE.replace("<p>Open", f"<{part}>Named part here</{name}><p>Open")
    learned = html_extract.weights_from(html_extract.labelled_counts(page))
    for weights in (learned, {}):
        assert html_extract.extract(page, weights) == TEXT.replace("Open", "Named part here Open")
    inner = html_extract.weights_from(html_extract.labelled_counts(PAGE))
    assert "Named part here" in html_extract.extract(page.replace("article>", "div>"), inner)


@pytest.mark.parametrize(
    "part",
    [
        "div class='ad'", "p class='x cookie-notice'", "div id=sidebar", "p hidden", "div aria-hidden=true",
        "div role='alert'", "section class='comments'",
    ],
)
def test_boilerplate_is_cut_whole(part):
    name = part.split()[0]
    page = PAGE.replace("<p>Open", f"<{part}>Some <b>words</b> here</{name}><p>Open")
    assert html_extract.extract(page, {}) == TEXT
    replies = "<div class='comments'><article><p>First words</p></article></div>"
    assert html_extract.extract(PAGE.replace("</article>", replies + "</article>"), {}) == TEXT
    assert html_extract.extract(PAGE.replace("</article>", "</article>" + replies), {}) == TEXT


TABLE = "<table>" + ("<tr>" + "<td>one</td>" * 6 + "</tr>") * 20 + "</table>"


@pytest.mark.parametrize("around, inside", [("", ""), ("<main><div>Path to here</div>", "</main>"), ("", "<article><p>Two</article>")])
def test_every_marked_page_teaches(around, inside):
    page = PAGE.replace("<article>", around + "<article>").replace("</article>", "</article>" + inside)
    learned = html_extract.labelled_counts(page)
    # what stands in main around the article is not its content
    assert learned["word", "h1", True] == 1 and learned["word", "div", True] == 0
    assert learned["word", "div", False] == 3 * bool(around)
    assert learned["word", "p", False] == 0 and learned["word", "p", True] == 4 + (not around and bool(inside))


def test_main_without_an_article_is_the_label():
    assert html_extract.labelled_counts(PAGE.replace("article>", "main>"))["word", "p", True] == 4
    assert html_extract.labelled_counts(PAGE.replace("article>", "div>")) is None


@pytest.mark.parametrize("tag", ["article>", "div>"])
def test_tables_no_labelled_page_has_stay(tag):
    learned = html_extract.weights_from(html_extract.labelled_counts(PAGE))
    page = PAGE.replace("<p>Open", TABLE + "<p>Open").replace("article>", tag)
    expected = TEXT.replace("Open", "one " * 120 + "Open")
    assert html_extract.extract(page, learned) == html_extract.extract(page, {}) == expected


def test_holders_of_deep_pages_are_found_in_one_pass():
    deep = "<div class='ad'>" * 50_000 + "<article><p>Some words of text here</article>"
    assert html_extract.extract(deep, {}) == "Some words of text here"


@pytest.mark.parametrize("seed", range(20))
def test_region_has_the_largest_sum(seed):
    random = np.random.default_rng(seed)
    kinds = ["p", "div", "li"]
    weights = {("tag", k): -float(random.integers(1, 5)) for k in kinds}
    weights |= {("word", k): float(random.integers(0, 3)) for k in kinds}
    sequence, last = [], "p"
    scores = []
    sequence.append(("tag", "p"))
    scores.append(weights["tag", "p"])
    for _ in range(30):
        if random.random() < 0.5:
            last = kinds[random.integers(3)]
            sequence.append(("tag", last))
            scores.append(weights["tag", last])
        else:
            count = int(random.integers(0, 6))
            sequence.append(("text", "w " * count))
            scores.append(weights["word", last] * count)
    first, stop = html_extract.region(sequence, weights)
    best = max(sum(scores[a:b]) for a, b in itertools.combinations_with_replacement(range(32), 2))
    assert sum(scores[first:stop]) == pytest.approx(best)


def test_pages_of_the_tables(spark, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r.page_id: r.text for r in queries.op6_html_extract(spark, sf_dir).collect()}
    for page in pages:
        inner = re.sub("</?b>", "", re.search("<article>(.*?)</article>", page.html, re.S)[1])
        blocks = [html.unescape(b) for b in re.split("<[^>]*>", inner)]
        assert found[page.page_id] == " ".join(" ".join(blocks).split())


# --- conversations ------------------------------------------------------------------


def cheapest(roles, costs):
    """Every way of merging, relabelling and inserting, in small."""
    best = {chat_format.START: 0.0}
    numbers = [chat_format.role_number(r) for r in roles]
    for role in numbers:
        after = {}
        for state, cost in best.items():
            if state:
                total = cost + costs.merge + costs.relabel * (role != state)
                after[state] = min(after.get(state, np.inf), total)
            for length in range(4):
                for path in itertools.product((1, 2, 3), repeat=length + 1):
                    at, legal = state, True
                    for step in path:
                        legal &= step in chat_format.NEXT[at]
                        at = step
                    if legal:
                        total = cost + length * costs.insert + costs.relabel * (path[-1] != role)
                        after[at] = min(after.get(at, np.inf), total)
        best = after
    return min(cost + chat_format.ending(state, costs)[0] for state, cost in best.items())


ROLES = ["system", "user", "assistant", "tool", None]


@pytest.mark.parametrize("costs", [chat_format.Costs(), chat_format.Costs(5, 1, 1), chat_format.Costs(1, 9, 1)])
def test_repair_is_cheapest(costs):
    for length in range(1, 5):
        for roles in itertools.product(ROLES, repeat=length):
            cost, steps = chat_format.repair(list(roles), costs)
            assert cost == cheapest(roles, costs)
            state = chat_format.START
            for before, step in steps:
                assert before == state
                for role in step.inserted:
                    assert role in chat_format.NEXT[state]
                    state = role
                if step.action != chat_format.MERGE:
                    assert step.role in chat_format.NEXT[state]
                state = step.role


def test_conversations_in_parts(spark):
    random = np.random.default_rng(3)
    rows = [(c, t, ROLES[random.integers(5)], f"t{t}") for c in range(12) for t in range(random.integers(1, 12))]
    rows += [(99, t, ROLES[random.integers(5)], None) for t in range(400)]  # one that fills partitions
    rows += [(None, 0, "user", "x"), (None, None, " Assistant", "y")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1))
    found = chat_format.format_conversations(frame).collect()
    assert len(found) == len(rows)
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1]))
        cost, _ = chat_format.repair([r[2] for r in turns])
        own = sorted((r for r in found if r.conv_id == conv), key=lambda r: (r.turn is not None, r.turn))
        assert sum(r.cost for r in own) == cost
        text = "".join(r.rendered for r in own)
        opened = [line.removeprefix("<|im_start|>") for line in text.split("\n") if line.startswith("<|im_start|>")]
        state = chat_format.START
        for role in opened:
            assert chat_format.ALIASES[role] in chat_format.NEXT[state]
            state = chat_format.ALIASES[role]
        assert state == chat_format.ASSISTANT and text.count("<|im_end|>") == len(opened)
    assert chat_format.format_conversations(frame.limit(0)).count() == 0


def test_parts_of_the_worked_example():
    costs = chat_format.Costs()
    numbers = [chat_format.role_number(r) for r in ("user", "assistant", "assistant", "assistant", "assistant")]
    steps, cost = cut_repair(numbers, [3], costs)
    assert cost == 3 and steps == chat_format.trace(
        numbers, chat_format._unit()[0], np.array([chat_format.ending(s, costs)[0] for s in range(4)]), costs
    )


def cut_repair(numbers, cuts, costs):
    """The repair of a conversation that is cut into parts, and its cost."""
    pieces = [numbers[a:b] for a, b in itertools.pairwise([0, *cuts, len(numbers)])]
    parts = []
    for piece in pieces:
        whole = chat_format.Part.empty()
        for role in piece:
            whole = whole.then(chat_format._matrices(costs)[role])
        parts.append(whole)
    states, unit = chat_format.borders(parts, costs), chat_format._unit()
    steps = []
    for k, piece in enumerate(pieces):
        steps += chat_format.trace(piece, unit[states[k]], unit[states[k + 1]], costs)
    return steps, sum(s.cost for _, s in steps) + chat_format.ending(states[-1], costs)[0]


@pytest.mark.parametrize("costs", [chat_format.Costs(), chat_format.Costs(5, 1, 1), chat_format.Costs(1, 9, 1)])
@pytest.mark.parametrize("seed", range(20))
def test_cuts_change_no_repair(seed, costs):
    random = np.random.default_rng(seed)
    for _ in range(20):
        roles = [ROLES[k] for k in np.repeat(random.integers(0, 5, 12), random.integers(1, 9, 12))]
        cuts = sorted(set(random.integers(1, len(roles), random.integers(1, 12)).tolist()))
        cost, steps = chat_format.repair(roles, costs)
        assert cut_repair([chat_format.role_number(r) for r in roles], cuts, costs) == (steps, cost)


@pytest.mark.parametrize("seed", range(3))
def test_long_runs_over_many_partitions(spark, seed):
    random = np.random.default_rng(seed)
    rows = []
    for conv in range(6):
        roles = np.repeat(random.integers(0, 5, 60), random.integers(1, 15, 60))
        rows += [(conv, t, ROLES[k], f"t{t}") for t, k in enumerate(roles)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = chat_format.format_conversations(frame).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    costs, template = chat_format.Costs(), chat_format.Template()
    for conv in range(6):
        turns = [r for r in rows if r[0] == conv]
        _, steps = chat_format.repair([r[2] for r in turns])
        own = sorted((r for r in found if r.conv_id == conv), key=lambda r: r.turn)
        assert [r.rendered for r in own] == [
            chat_format.segment(before, step, turn[3], k == len(turns) - 1, costs, template)
            for k, (turn, (before, step)) in enumerate(zip(turns, steps))
        ]


def test_rendering():
    [(before, first), (then, second)] = chat_format.repair(["user", "user"])[1]
    costs, template = chat_format.Costs(), chat_format.Template()
    text = chat_format.segment(before, first, "a", False, costs, template)
    text += chat_format.segment(then, second, "b", True, costs, template)
    assert text.startswith("<|im_start|>user\na")
    assert text.endswith("<|im_end|>\n")
