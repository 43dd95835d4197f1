"""Grouping spelling variants of words by blocked Gram matrices.

Words are counted over all texts.  A word is a vector of letter counts; one inserted or
deleted letter moves it by a squared distance of 1, one replaced letter by 2.  So at most two
letters have other counts in a near word.  The letters are dealt into ``GROUPS`` groups of like
weight, which leaves all but two groups unchanged: words meet under the counts of each choice of
unchanged groups.  There, words of one length are compared with those of the same length and
with those one longer: NumPy products of blocks of count vectors give all squared distances
of two blocks at once, pairs at most two apart are kept and their edits verified on the letters.
A pair that meets under several choices is kept under the first of them only.

Meeting places are counted first.  One with more than ``BLOCK`` words is cut by a hash into
parts, and each two parts are compared by a group of their own, so no task holds more
than two parts and no pair is left out.

A word's form is its most frequent near word, if that is ``ratio`` times as frequent; roots
follow forms by doubling steps: every step is at least ``ratio`` times as frequent, so there are few.

Defined cases: null texts have no words; a null id is an empty text in the seed of the
spelling errors; rows that share an id, and repeated rows, count one by one; near words of one
frequency are taken in code-point order; a word without near words has a count of 0, no
form and itself as root; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimworks.llm.common import CRC32_CHECKS, LOWER, UPPER, crc32_sql, handing_back, let
from claimworks.plans.workspace import write_lookup, write_table

# Letters that make words (fixed values).
LETTERS = "[A-Za-zÀ-ÿ]"
GROUPS = 4
BLOCK = 4096  # words of a meeting place that are compared in one group
TILE = 512  # rows of a product
ROWS_OUT = 20_000  # pairs handed on together
# The choices of groups that two near words agree in, and of each set of differing groups the
# first choice that avoids it.
CHOICES = list(combinations(range(GROUPS), GROUPS - 2))
FIRST_CHOICE = np.array(
    [
        next((k for k, groups in enumerate(CHOICES) if not any(mask >> g & 1 for g in groups)), -1)
        for mask in range(2**GROUPS)
    ]
)


def misspelt(word: Column, doc_id: Column, every: int) -> Column:
    """The word without one letter where ``every`` divides the hash of document and word."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word)

    def without(hashed: Column) -> Column:
        at = F.pmod(hashed, F.length(word)).cast("int")
        cut = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
        return F.when(hashed % every == 0, cut).otherwise(word)

    return let(F.crc32(key.cast("binary")), without)


def word_counts(docs: DataFrame, shortest: int = 6, fewest: int = 5, errors_every: int = 199) -> DataFrame:
    """word and n of the words of all texts, after planting spelling errors."""
    # an error only shortens a word: shorter runs come to nothing
    long_runs = F.lit(f"{LETTERS}{{{shortest},}}")
    runs = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), long_runs, F.lit(0))
    met = docs.select(F.col("doc_id").alias("seed"), F.explode(runs).alias("run"))
    met = met.select("seed", F.translate("run", UPPER, LOWER).alias("word"))
    words = met.select(misspelt(F.col("word"), F.col("seed"), errors_every).alias("word"))
    counts = words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= fewest)


def letter_groups(words: DataFrame) -> list[str]:
    """The letters, at most one row each, dealt so that each group has a like share of them all."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter != ''")
    counted = letters.groupBy("letter").count().collect()
    groups, weights = [""] * GROUPS, [0] * GROUPS
    for row in sorted(counted, key=lambda row: (-row["count"], row["letter"])):
        lightest = weights.index(min(weights))
        groups[lightest] += row["letter"]
        weights[lightest] += row["count"]
    return groups


def meetings(words: DataFrame, groups: list[str], block: int = BLOCK) -> DataFrame:
    """A row per word and comparison it takes part in: place, choice, size (of the shorter words), two
    parts, the row's own part, word, n."""

    def signature(choice: tuple[int, ...]) -> Column:
        others = "".join(letters for g, letters in enumerate(groups) if g not in choice)
        kept = F.translate("word", others, "") if others else F.col("word")
        return F.array_join(F.array_sort(F.split(kept, "")), "")

    keys = F.array(*[F.struct(F.lit(k).alias("choice"), signature(c).alias("counts")) for k, c in enumerate(CHOICES)])
    # as the shorter or equal side, and as the longer one
    sizes = F.array(F.length("word"), F.length("word") - 1)
    met = words.select("word", "n", F.explode(keys).alias("key"), sizes.alias("sizes"))
    met = met.select("word", "n", "key.choice", "key.counts", F.explode("sizes").alias("size"))
    place = ["choice", "counts", "size"]
    shorter = F.count_if(F.length("word") == F.col("size"))
    totals = met.groupBy(*place).agg(F.count(F.lit(1)).alias("met"), shorter.alias("shorter"))
    totals = totals.filter((F.col("shorter") > 0) & (F.col("met") > 1))
    parts = F.ceil(F.col("met") / F.lit(block)).cast("int")
    lookup = write_lookup(totals.select(*place, parts.alias("parts")), "spelling-places")
    found = met.join(F.broadcast(lookup.frame) if lookup.fits_broadcast() else lookup.frame, place)
    found = found.withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    paired = found.select(*place, "word", "n", "part", other)
    return paired.select(
        *place, F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "part", "word", "n"
    )


PLACE = ["choice", "counts", "size", "left", "right"]
PAIRS = "word string, n long, near string, near_n long"


class Side:
    """Words of one length: their letters and letter counts."""

    def __init__(self, words: list[str], ns: np.ndarray, group_of: np.ndarray) -> None:
        self.words, self.ns = words, ns
        size = len(words[0]) if words else 0
        # every letter is one byte in this encoding
        self.letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), size)
        # squares must stay exact
        kind = np.float32 if size < 2000 else np.float64
        rows = np.repeat(np.arange(len(words)), size)
        flat = np.bincount(rows * 256 + self.letters.ravel(), minlength=len(words) * 256)
        self.counts = flat.reshape(len(words), 256)[:, group_of >= 0].astype(kind)
        self.squares = np.einsum("ij,ij->i", self.counts, self.counts)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows differ by exactly one replaced letter or, where ``b`` is longer, one inserted one."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    ahead = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    behind = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= a.shape[1]


def near_pairs(one: Side, two: Side, choice: int, group_of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of near words; ``two`` may be ``one`` itself, then each pair comes once."""
    groups = group_of[group_of >= 0]
    for at in range(0, len(one.words), TILE):
        rows = slice(at, at + TILE)
        gram = one.counts[rows] @ two.counts.T
        gram *= -2
        gram += one.squares[rows, None]
        gram += two.squares
        i, j = np.nonzero(gram <= 2)
        i += at
        if one is two:
            i, j = i[i < j], j[i < j]
        for start in range(0, len(i), 65536):
            a, b = i[start : start + 65536], j[start : start + 65536]
            edited = one_edit(one.letters[a], two.letters[b])
            a, b = a[edited], b[edited]
            differing = one.counts[a] != two.counts[b]
            masks = np.zeros(len(a), np.int64)
            for g in range(GROUPS):
                masks |= differing[:, groups == g].any(1).astype(np.int64) << g
            first = FIRST_CHOICE[masks] == choice
            yield a[first], b[first]


def _compared(table: pa.Table, group_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Near pairs of one comparison, both ways."""
    choice, size = table["choice"][0].as_py(), table["size"][0].as_py()
    left, right = table["left"][0].as_py(), table["right"][0].as_py()
    words, ns = table["word"].to_pylist(), table["n"].to_numpy()
    parts = table["part"].to_numpy()
    lengths = np.fromiter(map(len, words), np.int64, len(words))

    def side(part: int, length: int) -> Side:
        rows = np.flatnonzero((parts == part) & (lengths == length))
        return Side([words[k] for k in rows], ns[rows], group_of)

    short, long = side(left, size), side(left, size + 1)
    if left == right:
        against = [(short, short), (short, long)]
    else:
        short_2, long_2 = side(right, size), side(right, size + 1)
        against = [(short, short_2), (short, long_2), (short_2, long)]
    for one, two in against:
        if not one.words or not two.words:
            continue
        for a, b in near_pairs(one, two, choice, group_of):
            if not len(a):
                continue
            first = pa.array([one.words[k] for k in a], pa.string())
            second = pa.array([two.words[k] for k in b], pa.string())
            n, m = pa.array(one.ns[a]), pa.array(two.ns[b])
            for row in ([first, n, second, m], [second, m, first, n]):
                yield pa.RecordBatch.from_arrays(row, ["word", "n", "near", "near_n"])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each comparison; takes rows sorted by ``PLACE``."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        key = [table[name].combine_chunks().to_numpy(zero_copy_only=False) for name in PLACE]
        changes = np.zeros(table.num_rows, bool)
        for column in key:
            changes[1:] |= column[1:] != column[:-1]
        if held and any(held[-1][name][0].as_py() != column[0] for name, column in zip(PLACE, key)):
            yield pa.concat_tables(held)
            held = []
        starts = [0, *np.flatnonzero(changes).tolist(), table.num_rows]
        for start, end in zip(starts, starts[1:]):
            if start:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(start, end - start))
    if held:
        yield pa.concat_tables(held)


def _comparer(groups: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_of = np.full(256, -1)
        for g, letters in enumerate(groups):
            group_of[list(letters.encode("latin-1"))] = g
        waiting, rows = [], 0
        for place in _places(batches):
            for found in _compared(place, group_of):
                waiting.append(found)
                rows += found.num_rows
                if rows >= ROWS_OUT:
                    yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                    waiting, rows = [], 0
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()

    return run


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n, near and near_n of all pairs that differ by one edit, both ways.  Takes word and n."""
    groups = letter_groups(words)
    met = meetings(words, groups, block).repartition(*PLACE).sortWithinPartitions(*PLACE)
    return met.mapInArrow(handing_back(_comparer(groups)), PAIRS)


def roots(links: DataFrame) -> DataFrame:
    """word and root of words with a form; takes word and form."""
    found = write_table(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = found.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        moved, moves = F.col("_to").isNotNull(), Observation()
        step = found.join(ahead, F.col("root") == F.col("_from"), "left").observe(
            moves, F.count_if(moved).alias("moved")
        )
        found = write_table(step.select("word", F.coalesce("_to", "root").alias("root")), "spelling-roots")
        if not moves.get["moved"]:
            return found


def spelling_variants(
    docs: DataFrame, shortest: int = 6, fewest: int = 5, errors_every: int = 199, ratio: int = 5, block: int = BLOCK
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every frequent word of all texts."""
    words = write_table(word_counts(docs, shortest, fewest, errors_every), "spelling-words")
    # the least by this order is the most frequent one, then the first by code points
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near")))
    near = near_words(words, block).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = F.col("best").isNotNull() & (-F.col("best.minus_n") >= ratio * F.col("n"))
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.minus_n")).alias("form_n"),
    )
    judged = write_table(judged, "spelling-forms")
    ends = roots(judged.filter(F.col("form").isNotNull()))
    rooted = judged.join(ends, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle_sql(shortest: int = 6, fewest: int = 5, errors_every: int = 199, ratio: int = 5) -> str:
    """DuckDB SQL for :func:`spelling_variants` over the documents table.

    Near words are found there by their rests after dropping a letter, not by letter counts.
    """
    code = "flatten(list_transform(points, lambda p: case when p < 128 then [p] else [192 + p // 64, 128 + p % 64] end))"
    return f"""
with recursive {CRC32_CHECKS},
met as (
  select doc_id, translate(run, '{UPPER}', '{LOWER}') as word, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '{LETTERS}+')) as run from documents) group by all),
bytes as (
  select word, n, list_transform(string_split(concat(doc_id, ':', word), ''), lambda c: unicode(c)) as points from met),
hashed as (
  select word, n, {crc32_sql(code)} as hash
  from bytes, checks),
spelt as (
  select case when hash % {errors_every} = 0
         then substr(word, 1, (hash % length(word))::int) || substr(word, (hash % length(word))::int + 2)
         else word end as word, n
  from hashed),
words as (
  select word, sum(n)::bigint as n from spelt where length(word) >= {shortest} group by word having sum(n) >= {fewest}),
cut as (
  select word, n, k, substr(word, 1, k::int) || substr(word, k::int + 2) as rest
  from (select word, n, unnest(range(length(word))) as k from words)),
longer as (select distinct c.word, c.n, w.word as near, w.n as near_n from cut c join words w on c.rest = w.word),
near as (
  select a.word, a.n, b.word as near, b.n as near_n
  from cut a join cut b on a.rest = b.rest and a.k = b.k and a.word <> b.word
  union select * from longer union select near, near_n, word, n from longer),
best as (
  select word, count(*) as n_near, min({{'minus_n': -near_n, 'near': near}}) as best from near group by word),
formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
         case when -best.minus_n >= {ratio} * w.n then best.near end as form,
         case when -best.minus_n >= {ratio} * w.n then -best.minus_n end as form_n
  from words w left join best b on w.word = b.word),
walk as (
  select word, word as root, 0 as steps from formed
  union all select k.word, f.form, steps + 1 from walk k join formed f on k.root = f.word where f.form is not null),
ends as (select word, arg_max(root, steps) as root from walk group by word)
select f.word, form, root, n, n_near, form_n from formed f join ends e on f.word = e.word"""
