import random

import public_tokenizers
import pytest
import sentencepiece

from claimworks.llm import queries, token_counts
from claimworks.llm.common import table
from claimworks.llm.sentencepiece_codec import BPE, BYTE, NORMAL, Spec, parse_model

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def model():
    with open(PIECES, "rb") as file:
        return parse_model(file.read())


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "▁", "a▁b", "▁▁a ", "aaaaaaaaaaaaa", "日本語のテキスト", "\n\n\n a\n", "a\0b",
    "<s> </s><0x0A>", " " * 50 + "x" + " " * 33, "a" * 10000, "ab" * 9000, "=-" * 5000 + "x", "🙂🙃" * 30, "​ x",
    "é" * 5001, "\t\r\n", "x" * 4096, "x" * 4097, ("word " * 3000).strip(), "don't stop", "<|endoftext|>",
]


def test_query_equals_the_library(spark, sf_dir, library):
    found = queries.QUERIES["op12_token_counts"](spark, sf_dir).collect()
    expected = []
    for row in table(spark, sf_dir, "documents").select("doc_id", "text").collect():
        n = len(library.encode(row.text or ""))
        expected.append((row.doc_id, len((row.text or "").encode()), n, n > 4096))
    assert sorted(map(tuple, found)) == sorted(expected)


def test_odd_and_long_texts(spark, documents, library):
    rows = [(k % 5 or None, text) for k, text in enumerate([*ODD, *ODD[:5]])]
    found = token_counts.count_tokens(documents(*rows, (9, None)), PIECES, limit=100).collect()
    expected = [(i, len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 100) for i, t in rows]
    key = lambda row: (row[0] or 0, *row[1:])
    assert sorted(map(tuple, found), key=key) == sorted([*expected, (9, 0, 0, False)], key=key)


def test_small_limits_change_nothing(model, library):
    """States are dropped, words forgotten and texts cut all the time."""
    counter = token_counts.Counter(model, states=50, words=3, chunk=7)
    for text in [*ODD, "the internationalisation of incomprehensibilities, the thing the the"]:
        assert counter(text) == len(library.encode(text)), text[:40]


def test_random_texts(model, library):
    rng, counter = random.Random(3), token_counts.Counter(model, chunk=50)
    letters = "aeinrst hlo  .,▁1é\n日🙂"
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert counter(text) == len(library.encode(text)), text


def naive(scores, text):
    """Merging by the definition: the best pair, then the leftmost one."""
    symbols = list("▁" + text.replace(" ", "▁")) if text else []
    while True:
        pairs = [(-scores[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in scores]
        if not pairs:
            return sum(1 if s in scores else len(s.encode()) for s in symbols)
        k = min(pairs)[1]
        symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]


@pytest.mark.parametrize("seed", range(12))
def test_random_models(seed):
    """Pieces that cross marks, pieces that merging never makes, equal scores, letters that are no pieces."""
    rng = random.Random(seed)
    letters = "ab▁" if seed % 2 else "abcd▁"
    pieces = {c: 0.0 for c in letters if c != "d"}
    while len(pieces) < 25:
        a, b = (rng.choice(list(pieces)) if rng.random() < 0.8 else rng.choice(letters) for _ in range(2))
        if len(a + b) < 9:
            pieces[a + b] = -float(rng.randrange(12))
    spec = Spec([(p, s, NORMAL) for p, s in pieces.items()] + [("<0x00>", 0.0, BYTE)], BPE, True, squeeze_spaces=False)
    counter = token_counts.Counter(spec, states=30, chunk=5)
    for _ in range(300):
        text = "".join(rng.choice(letters + " x") for _ in range(rng.randrange(30)))
        assert counter(text) == naive(pieces, text), (pieces, text)


def test_maps_compose_in_any_grouping(model):
    counter = token_counts.Counter(model)
    machine, text = counter.machine, "▁the▁internationalisationoftheaaaaaaaaaa▁end"
    cuts = [0, 3, 9, 10, 25, 38, len(text)]
    maps = [
        token_counts.chunk_map(machine, text[a:b], text[a - 1] if a else "") for a, b in zip(cuts, cuts[1:])
    ]
    scanned = token_counts.prefix_scan(maps, lambda a, b: a.then(b, machine))
    for end, whole in zip(cuts[1:], scanned):
        assert whole(machine, machine.start) == machine.run(machine.start, text[:end])
    left = maps[0].then(maps[1], machine).then(maps[2], machine)
    right = maps[0].then(maps[1].then(maps[2], machine), machine)
    assert left(machine, machine.start) == right(machine, machine.start)


def test_other_models_are_refused(spark, documents):
    with pytest.raises(ValueError, match="BPE"):
        token_counts.Counter(Spec([("a", 0.0, NORMAL)]))
    with pytest.raises(ValueError, match="byte fallback"):
        token_counts.Counter(Spec([("a", 0.0, NORMAL)], BPE, False, squeeze_spaces=False))


def test_empty_table(spark, documents):
    frame = token_counts.count_tokens(documents().limit(0), PIECES)
    assert frame.count() == 0 and frame.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
