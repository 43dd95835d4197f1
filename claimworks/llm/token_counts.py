"""Token counts by a finite-state transducer compiled from a BPE model.

BPE looks at a whole text, but its result is local: a sequence of pieces is the result if and
only if each two neighbours are the result for their own joined text.  So the result for a text
is found from those of its beginnings: after one more character the last piece is the one among
the pieces that end there that fits what the text before it ends with.  What this needs of the
past is finite: for each end of the text that begins some piece, the piece before it, and how many
pieces the text has had since.  These are the states; each transition reads a character and is
annotated with the number of tokens that it adds (or takes back).  States and transitions are
compiled when they are first met; equal ones are one, and beyond ``STATES`` all are dropped and
compiled anew.

Where no piece holds the two characters on both sides of a place, a token ends there whatever
came before, and all states lead to one.  A chunk of text is a map from the state before it to
the state after it and a count: it runs its head, the characters up to the first such place, from
the state it is given, and what follows is the same for all.  Maps compose, so chunks are run
on their own and put together by a prefix scan of logarithmic depth.  Words, which begin
at such places in usual models, are chunks whose maps are plain numbers: these are
remembered per word and added.

Defined cases: a null text is an empty one, with no bytes and no tokens; null ids and repeated rows
are carried along; very long texts and words are cut into chunks; an empty table gives
an empty result; other columns are ignored.  Models of other kinds, or with a character map, squeezed
spaces, user-defined or unused pieces, or without byte fallback, are refused.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.common import handing_back
from claimworks.llm.sentencepiece_codec import BPE, MARK, NORMAL, UNUSED, USER_DEFINED, Spec, parse_model

STATES = 200_000  # compiled at a time
WORDS = 400_000  # remembered at a time
MET = 2**23  # slots that remember which words were met
FITS = 300_000  # remembered pairs of pieces
CHUNK = 4096  # characters of a chunk of a long text
TEXTS = 500  # taken from a batch at a time


class Beginning:
    """Text that some piece begins with; a node of the tree of all pieces."""

    __slots__ = ("text", "is_piece", "longer")

    def __init__(self, text: str) -> None:
        self.text, self.is_piece = text, False
        self.longer: dict[str, Beginning] = {}


# A state is a dict of its transitions, character -> (state, tokens added); under this key
# it keeps what it knows of the past.
PAST = None
Past = tuple[tuple[Beginning, str, int], ...]


class Transducer:
    """States and transitions over the marked text, compiled as they are met."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.inside = {piece[k : k + 2] for piece in scores for k in range(len(piece) - 1)}
        self.fits: dict[tuple[str, str], bool] = {}
        self.empty = Beginning("")
        for piece in scores:
            node = self.empty
            for char in piece:
                if char not in node.longer:
                    node.longer[char] = Beginning(node.text + char)
                node = node.longer[char]
            node.is_piece = True
        self.reset()

    def reset(self) -> None:
        self.states: dict[Past, dict] = {}
        # (end of the text, piece before it, tokens since), longest end first
        self.beginning: Past = ((self.empty, "", 0),)
        self.start = self._state(self.beginning)

    def _state(self, past: Past) -> dict:
        state = self.states.get(past)
        if state is None:
            state = self.states[past] = {PAST: past}
        return state

    def merged(self, symbols: list[str]) -> list[str]:
        """The result of merging: always the leftmost of the pairs that make the best piece."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                score = self.scores.get(symbols[k] + symbols[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def fit(self, before: str, piece: str) -> bool:
        """Whether ``piece`` may follow ``before``, which is empty at the beginning."""
        known = self.fits.get((before, piece))
        if known is None:
            if len(self.fits) > FITS:
                self.fits.clear()
            wanted = [before, piece] if before else [piece]
            known = self.fits[before, piece] = self.merged(list(before + piece)) == wanted
        return known

    def certain(self, before: str, after: str) -> bool:
        """Whether a token ends between two characters whatever surrounds them."""
        return before + after not in self.inside

    def added(self, past: Past, char: str) -> tuple[Past, str, int]:
        """The past that counts, the text's last piece after ``char`` and the tokens it adds."""
        last = past[-1][1]
        if last and last[-1] + char not in self.inside:
            past = self.beginning  # a certain place makes all pasts alike
        for end, before, since in past:
            node = end.longer.get(char)
            if node is not None and node.is_piece and self.fit(before, node.text):
                return past, node.text, 1 - since
        # a character that is no piece is spelt in bytes
        if not self.fit(past[-1][1], char):
            raise AssertionError(f"no piece fits before the end of {char!r}")
        return past, char, len(char.encode())

    def after(self, past: Past, char: str, piece: str, added: int) -> list[tuple[Beginning, str, int]]:
        """What counts after ``char``; takes what :meth:`added` gives."""
        kept = [
            (end.longer[char], before, since + added) for end, before, since in past if char in end.longer
        ]
        kept.append((self.empty, piece, 0))
        return kept

    def compile(self, state: dict, char: str) -> tuple[dict, int]:
        """The transition of a state that it does not have yet."""
        past, piece, added = self.added(state[PAST], char)
        step = state[char] = self._state(tuple(self.after(past, char, piece, added))), added
        return step

    def run(self, state: dict, text: str) -> tuple[dict, int]:
        """The state after ``text`` and the tokens it adds."""
        total = 0
        for char in text:
            step = state.get(char)
            if step is None:
                step = self.compile(state, char)
            state = step[0]
            total += step[1]
        return state, total

    def count(self, text: str) -> int:
        """Tokens of ``text``.  Follows the transitions there are and compiles no more: most rare words
        do not come again."""
        state, total = self.start, 0
        for k, char in enumerate(text):
            step = state.get(char)
            if step is None:
                past = state[PAST]
                for char in text[k:]:
                    past, piece, added = self.added(past, char)
                    past = self.after(past, char, piece, added)
                    total += added
                break
            state = step[0]
            total += step[1]
        return total


@dataclass(frozen=True)
class StateMap:
    """What a chunk does to any state: run the head from it; then, if there is a tail, be in its state
    with its count added, whatever the state was."""

    head: str
    tail: tuple[dict, int] | None

    def __call__(self, machine: Transducer, state: dict) -> tuple[dict, int]:
        state, count = machine.run(state, self.head)
        return (state, count) if self.tail is None else (self.tail[0], count + self.tail[1])

    def then(self, other: StateMap, machine: Transducer) -> StateMap:
        """This map followed by another one."""
        if self.tail is None:
            return StateMap(self.head + other.head, other.tail)
        state, count = other(machine, self.tail[0])
        return StateMap(self.head, (state, self.tail[1] + count))


def chunk_map(machine: Transducer, chunk: str, before: str) -> StateMap:
    """The map of a chunk that stands after the character ``before`` ('' at the beginning)."""
    cut = 0
    for cut, char in enumerate(chunk):
        if not before or machine.certain(before, char):
            return StateMap(chunk[:cut], machine.run(machine.start, chunk[cut:]))
        before = char
    return StateMap(chunk, None)


def prefix_scan(maps: list, then: Callable) -> list:
    """Compositions of the first 1, 2, ... maps, in a logarithmic number of rounds."""
    if len(maps) < 2:
        return maps
    pairs = prefix_scan([then(a, b) for a, b in zip(maps[::2], maps[1::2])], then)
    found = [maps[0]]
    for k in range(1, len(maps)):
        found.append(pairs[k // 2] if k % 2 else then(pairs[k // 2 - 1], maps[k]))
    return found


class Counter:
    """Tokens of whole texts; one per worker."""

    def __init__(self, spec: Spec, states: int = STATES, words: int = WORDS, chunk: int = CHUNK) -> None:
        unusual = [kind for _, _, kind in spec.pieces if kind in (USER_DEFINED, UNUSED)]
        if spec.kind != BPE or spec.char_map or spec.squeeze_spaces or unusual:
            raise ValueError("only BPE models of plain pieces without normalisation can be compiled")
        if not (spec.dummy_prefix and spec.escape_spaces and spec.byte_fallback):
            raise ValueError("only models with a leading mark, marked spaces and byte fallback can be compiled")
        self.machine = Transducer({piece: score for piece, score, kind in spec.pieces if kind == NORMAL})
        self.by_word = not any(pair[1] == MARK != pair[0] for pair in self.machine.inside)
        self.known: dict[str, int] = {}
        self.met, self.marked = bytearray(MET), 0  # by the words' hashes
        self.states, self.words, self.chunk = states, words, chunk

    def _run(self, text: str, compiled: bool = True) -> int:
        """Tokens of a marked text or word."""
        machine = self.machine
        if len(machine.states) > self.states:
            machine.reset()
        if len(text) <= self.chunk:
            return machine.run(machine.start, text)[1] if compiled else machine.count(text)
        starts = range(0, len(text), self.chunk)
        # no map holds more than its head's characters and a state
        maps = [chunk_map(machine, text[k : k + self.chunk], text[k - 1] if k else "") for k in starts]
        return prefix_scan(maps, lambda a, b: a.then(b, machine))[-1](machine, machine.start)[1]

    def _words(self, words: list[str]) -> int:
        """Tokens of words, each standing after a mark that ends what was before."""
        try:
            return sum(map(self.known.get, words))
        except TypeError:  # a word that is not known
            pass
        total, known, met = 0, self.known, self.met
        for word in words:
            count = known.get(word)
            if count is None:
                # most words come once: they are remembered, and their states compiled, from the second time on
                slot = hash(word) & MET - 1
                count = self._run(MARK + word, met[slot])
                if met[slot]:
                    if len(known) > self.words:
                        known.clear()
                    known[word] = count
                else:
                    met[slot] = 1
                    self.marked += 1
            total += count
        if self.marked > MET // 2:
            self.met, self.marked = bytearray(MET), 0
        return total

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_word:
            return self._run(MARK + text.replace(" ", MARK))
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            # several marks in a row belong to the word after them
            marked = MARK + text.replace(" ", MARK)
            return self._words([chunk[1:] for chunk in re.findall(f"{MARK}+[^{MARK}]*", marked)])
        return self._words(text.split(" "))


@lru_cache(maxsize=1)
def counter_of(model: bytes) -> Counter:
    """One counter per worker, whatever the number of its tasks."""
    return Counter(parse_model(model))


def _counts(model: Broadcast, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter_of(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                tokens = [count(text or "") for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_bytes": part.column("n_bytes"),
                        "n_tokens": pa.array(tokens, pa.int64()),
                        "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
                    }
                )

    return run


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document.

    ``model_path`` names a model file that the driver can read; it is broadcast (a MB or so).
    """
    with open(model_path, "rb") as file:
        model = file.read()
    Counter(parse_model(model))  # refuses here what tasks would refuse
    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return narrow.mapInArrow(
        handing_back(_counts(shared, limit)), "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
