import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from claimworks.llm import queries, spelling_variants
from claimworks.llm.common import table
from oracle_compare import connect, difference


def brute(rows, shortest=6, fewest=5, every=199, ratio=5):
    """word -> (form, root, n, n_near, form_n) by the definition."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            hashed = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if hashed % every == 0:
                at = hashed % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= shortest and n >= fewest}
    near, rests = defaultdict(set), defaultdict(set)
    for word in counts:
        for k in range(len(word)):
            rests[k, word[:k] + word[k + 1 :]].add(word)
    for (_, rest), words in rests.items():
        alike = [*words, rest] if rest in counts else list(words)
        for a in alike:
            near[a] |= set(alike) - {a}
    form = {}
    for word, n in counts.items():
        if near[word]:
            best = min(near[word], key=lambda w: (-counts[w], w))
            if counts[best] >= ratio * n:
                form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def found(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_equals_sql(spark, sf_dir):
    frame = queries.QUERIES["op13_spelling_variants"](spark, sf_dir)
    assert difference(frame, connect(sf_dir), queries.ORACLE_SQL["op13_spelling_variants"]) is None


def test_equals_brute_force_on_random_words(spark, documents):
    rng = np.random.default_rng(5)
    # few letters, so that there are many near words, anagrams and chains
    words = ["".join(rng.choice(list("aabéß"), rng.integers(5, 9))) for _ in range(1500)]
    texts = [" ".join(rng.choice(words, 400, p=None)) for _ in range(30)]
    texts.append("-".join(w.upper() for w in words[:200]) * 3)
    rows = [(k % 28 if k else None, text) for k, text in enumerate(texts)]
    expected = brute(rows, 5, 2, 7, 2)
    assert any(root not in (form, word) for word, (form, root, *_) in expected.items() if form)
    for block in (4096, 16):  # 16: places are cut into parts
        frame = spelling_variants.spelling_variants(documents(*rows), 5, 2, 7, 2, block)
        assert found(frame) == expected


def test_nulls_empty_and_ties(spark, documents):
    rows = [(1, None), (2, ""), (3, "12 .."), (4, "colour " * 20 + "colourx " * 5 + "colours " * 5), (5, "kolour " * 20)]
    result = found(spelling_variants.spelling_variants(documents(*rows), errors_every=10**9))
    assert result == {
        "colour": (None, "colour", 20, 3, None), "kolour": (None, "kolour", 20, 1, None),
        "colours": (None, "colours", 5, 2, None), "colourx": (None, "colourx", 5, 2, None),
    }
    again = found(spelling_variants.spelling_variants(documents(*rows), errors_every=10**9, ratio=4))
    assert again["colours"] == ("colour", "colour", 5, 2, 20)


def test_equal_frequencies_take_the_first_word(spark, documents):
    text = "bandit " * 50 + "bandix " * 50 + "bandi " * 50 + "bandie " * 5
    result = found(spelling_variants.spelling_variants(documents((1, text)), errors_every=10**9))
    assert result["bandie"] == ("bandit", "bandit", 5, 2, 50)


def test_very_long_words(spark, documents):
    long = "x" * 3000
    rows = [(1, f"{long}a {long}b {long} " * 5 + f"{long}a " * 30)]
    result = found(spelling_variants.spelling_variants(documents(*rows), errors_every=10**9))
    assert result[long] == (long + "a", long + "a", 5, 2, 35)


def test_empty_table(spark, documents):
    assert spelling_variants.spelling_variants(documents().limit(0)).count() == 0
    assert spelling_variants.spelling_variants(documents((1, None))).count() == 0


def test_comparisons_hold_no_more_than_two_parts(spark, sf_dir):
    words = spelling_variants.word_counts(table(spark, sf_dir, "documents"), fewest=1)
    met = spelling_variants.meetings(words, spelling_variants.letter_groups(words), block=64)
    sizes = [r["count"] for r in met.groupBy(*spelling_variants.PLACE).count().collect()]
    assert max(sizes) < 4 * 64 and len(sizes) > 100


@pytest.mark.parametrize("a, b, near", [
    ("abc", "abd", True), ("abc", "abc", False), ("abc", "bca", False), ("abc", "abcd", True),
    ("abc", "xabc", True), ("abc", "axbc", True), ("abc", "xbcy", False), ("aab", "aaab", True),
])
def test_one_edit(a, b, near):
    sides = [np.frombuffer(w.encode(), np.uint8).reshape(1, -1) for w in (a, b)]
    assert spelling_variants.one_edit(*sides).tolist() == [near]
