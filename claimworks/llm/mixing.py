"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the mix over its share of the rows.
Each row appears as often as a Poisson variable of that mean says: a uniform number hashed
from the seed and the row is looked up in the distribution's running sums (inversion).
The rows are exploded by their counts and dealt out in a random order that is hashed, too.
So every run gives the same mix, in any partitioning, and no row is drawn with the help of
another one.

A row's draw comes from a digest of all its columns and from its number among the rows that are equal
in all of them, so that each row has a draw of its own, whatever ids it shares. Equal rows are
found by their hashes.  They are not numbered where they lie but counted, by partial counts,
and then exploded block by block: a row that comes a million times is never gathered.

Rates come from counts over all rows.  They are copied to the executors if their measured
size allows and otherwise joined with salted keys, because one source may hold a third of
the rows.  A mean over ``SPLIT`` is drawn as a sum of smaller ones, so tables of running sums stay
short and e^-mean stays in range.

Defined cases: a null source is a source of its own, weighted under the key ``None``; a
source without a weight gets the default one, a weight of 0 removes it; rows with null or shared
ids, and repeated rows, have a draw each; an empty table gives an
empty result; other columns, whatever their names and types, are carried along, but for
columns named ``copy`` or ``place``, which the result's own replace.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.llm.common import masked, unmasked
from claimworks.plans.workspace import write_lookup, write_table

SPLIT = 16.0
# Running sums reach 1 within double precision at this count for any mean up to SPLIT.
LONGEST = 80
SALTS = 32
BLOCK = 1000  # equal rows that one task writes out
DIGITS = 13  # hexadecimal digits of a hash that make a uniform number


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) hashed from the parts; null counts as a text of its own."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    digits = F.substring(F.md5(text.cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**DIGITS))


def running_sums(mean: Column) -> Column:
    """P(count <= k) for k = 0 .. LONGEST of a Poisson variable of ``mean`` <= SPLIT."""
    begin = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))
    ks = F.sequence(F.lit(1), F.lit(LONGEST))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        total = F.element_at(state["sums"], -1) + p
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(total)).alias("sums"))

    return F.aggregate(ks, begin, add, lambda state: state["sums"])


def rates(docs: DataFrame, weights: Mapping[str | None, float], default: float, size: float) -> DataFrame:
    """source, rate, parts and sums: the means that turn the rows into ``size`` times as many."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    weight = F.lit(float(default))
    for source, value in weights.items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(value))).otherwise(weight)
    weighted = write_table(counts.withColumn("weight", weight), "mix-counts")
    total = weighted.agg(F.sum("rows").alias("rows"), F.sum("weight").alias("weights")).first()
    all_rows, all_weights = F.lit(total["rows"] or 0), F.lit(total["weights"] or 1.0)
    rate = F.col("weight") / all_weights * all_rows / F.col("rows") * F.lit(float(size))
    parts = F.greatest(F.ceil(F.col("rate") / F.lit(SPLIT)), F.lit(1)).cast("int")
    return (
        weighted.select("source", rate.alias("rate"))
        .withColumn("parts", parts)
        .withColumn("sums", running_sums(F.col("rate") / F.col("parts")))
    )


def row_digest(schema: T.StructType) -> Column:
    """A digest of all columns of a masked row; each value is preceded by its length."""

    def value(at: int, field: T.StructField) -> Column:
        column = F.col(f"c{at}")
        nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))
        # JSON tells a nested null from the text of null, and drops nothing that differs
        text = F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"}) if nested else column.cast("string")
        known = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        return F.coalesce(F.when(column.isNotNull(), known), F.lit("n"))

    return F.md5(F.concat(F.lit(""), *[value(at, field) for at, field in enumerate(schema)]).cast("binary"))


def numbered(docs: DataFrame) -> DataFrame:
    """The masked columns, source, key (digest) and occurrence (from 0 among equal rows)."""
    plain = docs.select(*masked(docs), F.col("source").alias("source"))
    rows = plain.withColumn("key", row_digest(docs.schema))
    hashed = rows.select(F.xxhash64("key").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("met"))
    repeats = Observation()
    shared = hashed.filter(F.col("met") > 1).select("hash").observe(repeats, F.count(F.lit(1)).alias("hashes"))
    lookup = write_lookup(shared, "mix-repeats")
    if not repeats.get["hashes"]:
        return rows.withColumn("occurrence", F.lit(0))
    known = F.broadcast(lookup.frame) if lookup.fits_broadcast() else lookup.frame
    with_hash = rows.withColumn("hash", F.xxhash64("key"))
    alone = with_hash.join(known, "hash", "left_anti").drop("hash").withColumn("occurrence", F.lit(0))
    # rows of one key are equal in every column
    any_of = [F.any_value(name).alias(name) for name in plain.columns]
    met = F.count(F.lit(1)).cast("int").alias("met")
    counted = with_hash.join(known, "hash", "left_semi").groupBy("key").agg(*any_of, met)
    # a row that is met very often is written out by several tasks
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("met") - 1) / BLOCK).cast("int"))).alias("block")
    cut = counted.select(*plain.columns, "key", "met", blocks).repartition("key", "block")
    first = F.col("block") * BLOCK
    occurrences = F.explode(F.sequence(first, F.least(first + BLOCK, F.col("met")) - 1)).alias("occurrence")
    return alone.unionByName(cut.select(*plain.columns, "key", occurrences))


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float],
    default: float = 1.0,
    size: float = 1.0,
    seed: int = 17,
) -> DataFrame:
    """The rows of ``docs``, replicated, with ``copy`` (from 0) and ``place``, in random order.

    ``weights`` gives target weights by source, ``default`` those of all others; ``size`` is
    the expected number of rows over that of the input.
    """
    names = [name for name in docs.columns if name.lower() not in ("copy", "place")]
    lookup = write_lookup(rates(docs, weights, default, size), "mix-rates")
    means = lookup.frame.select(F.col("source").alias("mean_source"), "parts", "sums")
    rows = numbered(docs)
    same = F.col("source").eqNullSafe(F.col("mean_source"))
    if lookup.fits_broadcast():
        rated = rows.join(F.broadcast(means), same)
    else:
        salt = F.pmod(F.xxhash64("key", "occurrence"), F.lit(SALTS))
        spread = means.withColumn("salt_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rated = rows.withColumn("salt", salt).join(spread, same & (F.col("salt") == F.col("salt_of")))
    draw = lambda k: uniform(F.lit(seed), F.lit("count"), F.col("key"), F.col("occurrence"), k)
    # counts are drawn before anything refers to them twice: a draw hashes
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")),
        F.lit(0),
        lambda total, k: total
        + F.size(F.transform(F.array(draw(k)), lambda u: F.filter(F.col("sums"), lambda s: s <= u))[0]),
    )
    copies = F.explode(F.when(drawn > 0, F.sequence(F.lit(0), drawn - 1)).otherwise(F.array().cast("array<int>")))
    kept = [f"c{at}" for at in range(len(docs.columns))]
    exploded = rated.select(*kept, "key", "occurrence", copies.alias("copy"))
    place = uniform(F.lit(seed), F.lit("place"), F.col("key"), F.col("occurrence"), F.col("copy"))
    placed = exploded.select(*kept, "key", "copy", place.alias("place"))
    ordered = placed.repartition("place").sortWithinPartitions("place", "key", "copy")
    return ordered.select(*unmasked(docs, names=names), "copy", "place")


def oracle_sql(
    weights: Mapping[str | None, float], default: float = 1.0, size: float = 1.0, seed: int = 17
) -> str:
    """DuckDB SQL for the rows of :func:`mix` over the documents table."""
    cases = " ".join(f"when source = '{s}' then {float(v)}" for s, v in weights.items())
    weight = f"case {cases} else {float(default)} end" if cases else f"{float(default)}"
    names = "doc_id, text, lang, source, n_chars"
    texts = ", ".join(f"coalesce(length({n}::varchar) || ':' || {n}::varchar, 'n')" for n in names.split(", "))
    uniform_of = "('0x' || substr(md5({}), 1, 13))::ubigint::double / 4503599627370496.0".format
    draw = uniform_of(f"concat_ws(':', '{seed}', 'count', key, occurrence, k)")
    place = uniform_of(f"concat_ws(':', '{seed}', 'place', key, occurrence, copy)")
    return f"""
with counts as (select source, count(*) as n, {weight} as weight from documents group by source),
rated as (
  select source, weight / sum(weight) over () * sum(n) over () / n * {float(size)} as rate from counts),
split as (select source, rate, greatest(ceil(rate / {SPLIT}), 1)::int as parts from rated),
pmf as (
  select source, parts, k, case when rate = 0 then (k = 0)::int::double
         else exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1)) end as p
  from split, range(0, {LONGEST + 1}) r(k)),
cdf as (
  select source, parts, list(total order by k) as sums
  from (select source, parts, k, sum(p) over (partition by source order by k) as total from pmf)
  group by source, parts),
keyed as (select {names}, md5(concat({texts})) as key from documents),
numbered as (select *, row_number() over (partition by key) - 1 as occurrence from keyed),
draws as (
  select d.*, c.parts, c.sums, unnest(range(1, c.parts + 1)) as k
  from numbered d join cdf c on d.source is not distinct from c.source),
drawn as (
  select {names}, key, occurrence, sum(len(list_filter(sums, lambda s: s <= u))) as n
  from (select *, {draw} as u from draws) group by all),
copies as (select {names}, key, occurrence, unnest(range(0, n::bigint))::int as copy from drawn)
select {names}, copy, {place} as place from copies"""
