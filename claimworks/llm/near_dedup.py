"""Near-duplicate documents by b-bit MinHash.

One pass over the texts gives every document 128 minima over its distinct word shingles:
full minima make 32 band keys of 4, and two low bits of each are packed into four longs.
Documents with the same words are one class, represented by their smallest id.  Band
buckets propose pairs of classes, the packed bits estimate their similarity (matching
fields, corrected for chance agreement, by XOR and bit counts), and what the estimate does
not exclude is confirmed on the full shingle sets.

A bucket never emits all of its pairs.  First every member is compared with the bucket's
smallest class; the confirmed links are contracted to components.  Only buckets that still
hold several components are searched further, in blocks of bounded size, by signatures of
1,024 minima made for just these classes, and only pairs across components that pass the
sharper estimate, and a comparison of their hashed shingle sets, leave a block.  So each pair that shares a bucket is either tested or
already connected.

Chance of losing a pair at similarity 0.8: (1 - 0.8^4)^32 = 5e-8 by the bands, and below
1e-6 by an estimate, whose bound lies five standard deviations under the threshold.

Defined cases: a text without words has no shingles and is linked with nothing; a text of
fewer words than a shingle is one shingle; a null ``doc_id`` takes part in nothing and is
kept (its component is null); rows that repeat an id are judged by their own text each: if
any id stands for differing words, every row is numbered and takes part under its number, and
of a component the rows of the smallest id, and of these of one digest of words, are kept;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from claimworks.llm.common import LOWER, UPPER, handing_back, let, lower_ascii, masked, shingles, unmasked, words
from claimworks.plans.workspace import write_lookup, write_table

ROWS = 4  # minima in a band
BANDS = 32
HASHES = ROWS * BANDS
WIDE = 1024  # minima of the classes that a second search compares
BITS = 2  # kept of each minimum
BLOCK = 256  # classes of one block of a large bucket
CACHED_WORDS = 200_000
CHUNK = 2048  # shingles hashed at a time

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def lanes(hashes: int) -> list[str]:
    """Columns that hold the packed bits of so many minima."""
    return [f"s{k}" for k in range(hashes * BITS // 64)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    """64-bit hash of each word, remembered for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _shingle_hashes(tokens: list[bytes], size: int, hashes: _WordHashes) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles."""
    ids = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    runs = max(1, len(ids) - size + 1)
    total = np.zeros(runs, np.uint64)
    for k in range(min(size, len(ids))):
        total = _mixed(total * _ODD + ids[k : k + runs])
    return np.unique(total)


def _minima(shingle_hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least value of the shingles under each of the random multiplications."""
    short = (shingle_hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), CHUNK):
        np.minimum(least, (factors * short[at : at + CHUNK]).min(axis=1), out=least)
    return least.astype(np.uint64)


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low bits of the minima, ``BITS`` each, packed into longs."""
    low = (_mixed(minima * _ODD) & np.uint64(2**BITS - 1)).reshape(-1, 64 // BITS)
    shift = np.arange(low.shape[1], dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shift, axis=1).view(np.int64)


def _band_keys(minima: np.ndarray) -> np.ndarray:
    rows = minima.reshape(-1, ROWS)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = _mixed(key * _ODD + rows[:, k])
    return key.view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


def _signer(size: int, seed: int, count: int, with_sets: bool):
    names = lanes(count)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        random = np.random.default_rng(seed)
        factors = random.integers(0, 2**32, (count, 1), np.uint32) | np.uint32(1)
        hashes = _WordHashes()
        for batch in batches:
            found, keys, packed, bands, sets = [], [], [], [], []
            for text in batch.column(1):
                raw = text.as_py()
                # on bytes, lower() and split() know ASCII only
                tokens = raw.lower().split() if raw else []
                if not tokens:
                    found.append(0)
                    keys.append((0, 0))
                    packed.append(np.zeros(len(names), np.int64))
                    bands.append(np.zeros(0, np.int64))
                    sets.append(np.zeros(0, np.int64))
                    continue
                distinct = _shingle_hashes(tokens, size, hashes)
                minima = _minima(distinct, factors)
                found.append(len(distinct))
                keys.append(np.frombuffer(xxhash.xxh3_128_digest(b" ".join(tokens)), np.int64))
                packed.append(_packed(minima))
                bands.append(_band_keys(minima))
                sets.append(distinct.view(np.int64) if with_sets else np.zeros(0, np.int64))
            keys_of = np.asarray(keys, np.int64).reshape(-1, 2)
            packed_of = np.asarray(packed, np.int64).reshape(-1, len(names))
            columns = {"doc_id": batch.column(0), "n_shingles": pa.array(found, pa.int64())}
            columns |= {f"k{k}": pa.array(keys_of[:, k]) for k in range(2)}
            columns |= {name: pa.array(packed_of[:, k]) for k, name in enumerate(names)}
            columns["bands"] = _lists(bands)
            if with_sets:
                columns["shingles"] = _lists(sets)
            yield pa.RecordBatch.from_pydict(columns)

    return sign


def signatures(
    docs: DataFrame, size: int = 4, seed: int = 1, hashes: int = HASHES, with_sets: bool = False
) -> DataFrame:
    """doc_id, n_shingles, words' digest (k0, k1), packed bits (s0..) and band keys.

    ``with_sets`` adds the hashed shingles.
    """
    bits = ", ".join(f"{name} long" for name in lanes(hashes))
    schema = f"doc_id long, n_shingles long, k0 long, k1 long, {bits}, bands array<long>"
    schema += ", shingles array<long>" * with_sets
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return narrow.mapInArrow(handing_back(_signer(size, seed, hashes, with_sets)), schema)


# --- similarity of packed signatures ------------------------------------------


def chance_agreement() -> float:
    """Share of fields that agree although the minima differ."""
    return 2.0**-BITS


def least_matches(threshold: float, hashes: int = HASHES) -> int:
    """Fields that agree at ``threshold``, less five standard deviations."""
    share = threshold + (1 - threshold) * chance_agreement()
    return math.floor(hashes * share - 5 * math.sqrt(hashes * share * (1 - share)))


def similarity(matches: float, hashes: int = HASHES) -> float:
    """Similarity that so many agreeing fields stand for."""
    return (matches / hashes - chance_agreement()) / (1 - chance_agreement())


_LOW_BITS = 0x5555555555555555


def matching_fields(a: str, b: str) -> Column:
    """Agreeing fields of two signatures whose columns are named ``a + 's0'`` and so on."""
    total = F.lit(HASHES)
    for name in lanes(HASHES):
        differ = F.col(a + name).bitwiseXOR(F.col(b + name))
        either = differ.bitwiseOR(F.shiftrightunsigned(differ, 1))
        total = total - F.bit_count(either.bitwiseAND(F.lit(_LOW_BITS)))
    return total


# --- links --------------------------------------------------------------------


def _with_signatures(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    for side in "ab":
        own = [F.col(name).alias(f"{side}_{name}") for name in ("n", *lanes(HASHES))]
        pairs = pairs.join(classes.select(F.col("rep").alias(side), *own), side)
    return pairs


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id and text of the wanted ids.

    Their list is copied to the executors if its measured size allows; otherwise the texts
    are shuffled.
    """
    ids = write_lookup(wanted.distinct(), "dedup-wanted")
    listed = F.broadcast(ids.frame) if ids.fits_broadcast() else ids.frame
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(listed, "doc_id", "left_semi")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full shingle sets are similar enough."""
    pairs = write_table(pairs, "dedup-candidates")
    texts = write_table(
        _texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))), "dedup-texts"
    )
    for side in "ab":
        pairs = pairs.join(texts.withColumnsRenamed({"doc_id": side, "text": f"{side}_text"}), side)
    sets = [let(words(lower_ascii(F.col(f"{s}_text"))), lambda w: shingles(w, size)) for s in "ab"]
    sizes = let(
        F.struct(sets[0].alias("a"), sets[1].alias("b")),
        lambda s: F.struct(
            F.size(F.array_intersect(s["a"], s["b"])).alias("both"),
            (F.size(s["a"]) + F.size(s["b"])).alias("sum"),
        ),
    )
    judged = pairs.select("a", "b", sizes.alias("n"))
    both = F.col("n")["both"]
    return judged.filter(100 * both >= percent * (F.col("n")["sum"] - both)).select("a", "b").distinct()


def _blocks_compared(percent: int):
    """Pairs across components within one block, or between two, by wide signatures."""
    limit, names = least_matches(percent / 100, WIDE), lanes(WIDE)

    def compare(group: pa.Table) -> pa.Table:
        rep, comp, n, block = (group.column(x).to_numpy() for x in ("rep", "comp", "n", "block"))
        i, j, least = (group.column(x)[0].as_py() for x in ("i", "j", "least"))
        bits = np.stack([group.column(x).to_numpy() for x in names], 1).view(np.uint64)
        own, other = np.flatnonzero(block == i), np.flatnonzero(block == j)
        # pairs with the smallest member were tested before
        own, other = own[rep[own] != least], other[rep[other] != least]
        lists = group.column("shingles").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        found_a, found_b = [], []
        one, low = np.uint64(1), np.uint64(_LOW_BITS)
        for x in own:
            y = other[comp[other] != comp[x]]
            if i == j:
                y = y[rep[y] > rep[x]]
            # sets of very different sizes cannot be similar
            y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
            differ = bits[y] ^ bits[x]
            differ = (differ | (differ >> one)) & low
            y = y[WIDE - np.bitwise_count(differ).sum(axis=1, dtype=np.int64) >= limit]
            mine = flat[ends[x] : ends[x + 1]]
            both = np.array(
                [len(np.intersect1d(mine, flat[ends[k] : ends[k + 1]], assume_unique=True)) for k in y], np.int64
            )
            y = y[100 * both >= percent * (n[x] + n[y] - both)]
            found_a.append(np.minimum(rep[x], rep[y]))
            found_b.append(np.maximum(rep[x], rep[y]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *found_a]), "b": np.concatenate([none, *found_b])})

    return compare


def _across(
    docs: DataFrame, members: DataFrame, roots: DataFrame, size: int, percent: int, seed: int, block: int
) -> DataFrame:
    """Similar pairs (a, b) of one bucket whose classes lie in different components.

    Buckets with the same smallest class are searched as one.
    """
    labelled = members.filter("members > 2").join(roots, F.col("rep") == F.col("node"), "left")
    labelled = labelled.select("key", "rep", "least", F.coalesce("root", "rep").alias("comp"))
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    mixed = mixed.filter("lo <> hi").select("key")
    left = labelled.join(mixed, "key", "left_semi").select("least", "rep", "comp").distinct()
    left = write_table(left, "dedup-mixed")
    sized = left.groupBy("least").agg(F.count(F.lit(1)).alias("members"))
    wide = signatures(_texts_of(docs, left.select(F.col("rep").alias("doc_id"))), size, seed, WIDE, True)
    wide = wide.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "shingles", *lanes(WIDE))
    parts = F.ceil(F.col("members") / F.lit(block)).cast("int")
    placed = (
        left.join(sized, "least")
        .withColumn("block", F.pmod(F.xxhash64("rep"), parts).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("i", F.least("block", "with"))
        .withColumn("j", F.greatest("block", "with"))
        .join(write_table(wide, "dedup-wide"), "rep")
    )
    return placed.groupBy("least", "i", "j").applyInArrow(_blocks_compared(percent), "a long, b long")


def _components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node reached.

    Alternates linking larger neighbours to the smallest one and linking smaller ones to it,
    until nothing changes; each round is written, so no lineage grows.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        links = (
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.withColumnRenamed("m", "v"))
            .distinct()
        )
        seen = Observation()
        links = write_table(
            links.observe(
                seen, F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
            ),
            "dedup-links",
        )
        now = (seen.get["rows"], seen.get["sum"])
        if now == before or not now[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _roots(
    docs: DataFrame, signed: DataFrame, size: int, percent: int, seed: int, block: int
) -> DataFrame:
    """doc_id, n_shingles, k0, k1 and root of every row; an id stands for the same words only."""
    spoken = signed.filter("n_shingles > 0 and doc_id is not null")
    keys = spoken.groupBy("k0", "k1").agg(F.min("doc_id").alias("rep"))
    keys = write_table(keys, "dedup-classes")
    classes = write_table(
        spoken.join(keys.withColumnRenamed("rep", "doc_id"), ["k0", "k1", "doc_id"])
        .select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), *lanes(HASHES), "bands"),
        "dedup-signed-classes",
    )
    postings = classes.select("rep", F.explode("bands").alias("key"))
    buckets = write_table(
        postings.groupBy("key")
        .agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("members"))
        .filter("members > 1"),
        "dedup-buckets",
    )
    members = write_table(postings.join(buckets, "key"), "dedup-members")
    star = members.filter("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b"))
    likely = _with_signatures(star.distinct(), classes).filter(
        (matching_fields("a_", "b_") >= least_matches(percent / 100))
        & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    )
    links = write_table(confirmed(likely.select("a", "b"), docs, size, percent), "dedup-star")
    roots = _components(links)
    across = _across(docs, members, roots, size, percent, seed, block).distinct()
    more = write_table(confirmed(across, docs, size, percent), "dedup-more")
    if not more.isEmpty():
        roots = _components(links.unionByName(more))

    final = keys.join(roots, F.col("rep") == F.col("node"), "left").select(
        "k0", "k1", F.coalesce("root", "rep").alias("_root")
    )
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    joined = signed.filter(linked).join(final, ["k0", "k1"])
    alone = signed.filter(~linked).withColumn("_root", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "k0", "k1", F.col("_root").alias("root")]
    return joined.select(*columns).unionByName(alone.select(*columns))


def _ids_clash(signed: DataFrame) -> bool:
    """Whether an id stands for differing words."""
    digests = [f(k).alias(f"{f.__name__}_{k}") for f in (F.min, F.max) for k in ("k0", "k1")]
    by_id = signed.filter("doc_id is not null").groupBy("doc_id").agg(*digests)
    return not by_id.filter("min_k0 <> max_k0 or min_k1 <> max_k1").isEmpty()


def _judged(
    docs: DataFrame, size: int = 4, percent: int = 80, seed: int = 1, block: int = BLOCK
) -> tuple[DataFrame, DataFrame | None]:
    """doc_id, n_shingles, component_id and kept of every row; the numbered rows if ids clash.

    If they do, the judged rows have their number (``_row``) and digest (k0, k1) too.
    """
    signed = write_table(signatures(docs, size, seed), "dedup-signatures")
    if not _ids_clash(signed):
        found = _roots(docs, signed, size, percent, seed, block).withColumnRenamed("root", "component_id")
        kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        return found.drop("k0", "k1").withColumn("kept", kept), None
    number = F.when(F.col("doc_id").cast("long").isNotNull(), F.monotonically_increasing_id())
    rows = write_table(docs.withColumn("_row", number), "dedup-rows")
    single = rows.select(F.col("_row").alias("doc_id"), "text")
    signed = write_table(signatures(single, size, seed), "dedup-row-signatures")
    roots = _roots(single, signed, size, percent, seed, block).withColumnRenamed("doc_id", "_row")
    ids = rows.select("_row", F.col("doc_id").cast("long").alias("doc_id")).filter("_row is not null")
    found = write_table(roots.join(ids, "_row", "left"), "dedup-row-roots")
    own = F.struct("doc_id", "k0", "k1")
    first = found.filter("n_shingles > 0").groupBy("root").agg(F.min(own).alias("first"))
    found = found.join(first, "root", "left")
    component = F.coalesce(F.col("first")["doc_id"], F.col("doc_id")).alias("component_id")
    kept = F.coalesce(own == F.col("first"), F.lit(True)).alias("kept")
    return found.select("_row", "k0", "k1", "doc_id", "n_shingles", component, kept), rows


def near_duplicates(
    docs: DataFrame, size: int = 4, percent: int = 80, seed: int = 1, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Documents are linked if their sets of ``size``-word shingles share ``percent`` of their
    union; the smallest id of each component is kept.
    """
    found, _ = _judged(docs.select("doc_id", "text"), size, percent, seed, block)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one of those that repeat id and words."""
    # whatever the columns are called, they are in the way of none here
    own = ("doc_id", "text")
    return _one_of_each(docs.select(*masked(docs, own)), **options).select(*unmasked(docs, own))


def _one_of_each(docs: DataFrame, **options: int) -> DataFrame:
    found, rows = _judged(docs, **options)
    found = write_table(found, "dedup-found")
    if rows is not None:
        one = found.filter(F.col("kept") & F.col("_row").isNotNull()).groupBy("doc_id", "k0", "k1")
        one = one.agg(F.min("_row").alias("_row")).select("_row")
        kept = rows.join(one, "_row", "left_semi").unionByName(rows.filter("_row is null"))
        return kept.select(*docs.columns)
    stay = found.filter(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id")
    repeated = found.groupBy("doc_id").count().filter("count > 1 and doc_id is not null")
    repeated = write_table(repeated.select("doc_id"), "dedup-repeated")
    ids = write_lookup(stay.join(repeated, "doc_id", "left_anti"), "dedup-kept")
    listed = F.broadcast(ids.frame) if ids.fits_broadcast() else ids.frame
    kept = docs.join(listed, "doc_id", "left_semi").unionByName(docs.filter("doc_id is null"))
    if repeated.isEmpty():
        return kept
    several = docs.join(repeated.join(stay, "doc_id", "left_semi"), "doc_id", "left_semi")
    # partial aggregates: a row that is repeated very often is not gathered
    others = [name for name in docs.columns if name != "doc_id"]
    one = several.groupBy("doc_id").agg(F.min_by(F.struct(*others), "text").alias("first"))
    return kept.unionByName(one.select("doc_id", "first.*"))


def oracle_sql(size: int = 4, percent: int = 80) -> str:
    """DuckDB SQL for :func:`near_duplicates` over the documents table, whose ids are unique."""
    return rf"""
with recursive split as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as words
  from documents),
runs as (
  select doc_id, unnest(range(greatest(len(words) - {size - 1}, 1))) as k, words from split where len(words) > 0),
sets as (select distinct doc_id, array_to_string(words[k + 1 : k + {size}], ' ') as shingle from runs),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= {percent} * (x.n + y.n - common)),
both_ways as (select a, b from links union select b, a from links),
reached as (
  select a as doc_id, b as other from both_ways
  union select r.doc_id, w.b from reached r join both_ways w on r.other = w.a),
least as (select doc_id, min(other) as other from reached group by doc_id)
select d.doc_id, coalesce(s.n, 0) as n_shingles, least(d.doc_id, coalesce(l.other, d.doc_id)) as component_id,
       d.doc_id = least(d.doc_id, coalesce(l.other, d.doc_id)) as kept
from documents d left join sizes s on d.doc_id = s.doc_id left join least l on d.doc_id = l.doc_id"""
