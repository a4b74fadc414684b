"""BPE encoding by a tokenization automaton that is compiled from the merges.

The automaton accepts exactly the token sequences that BPE produces, and its arcs are labelled with
tokens. It starts with one state per base symbol and an arc from every state for every symbol. Each
merge (a, b) -> t, in order, adds one gadget:

* the arc b out of the state after a is cut;
* arc t leaves every state that arc a left at that time (the cut of this gadget included), and
* it leads to a new state that has the arcs of the state after b as they were before this gadget.

Expanded, that table has a row per token and a column per token, so the gadgets are kept as they are:
the cut arcs with their time, and for each token the two links it inherits by. An arc is resolved by
following the links once and is then a lookup in the transition table of the worker.

The automaton is deterministic, so a pre-split word has one accepted path, and so has each prefix of
it. It is found from left to right by table look-ups.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.text import worker_table

NO_TIME = 1 << 40

#: Words remembered per Python worker in a young table. A full one becomes the old one, and what is used
#: again moves on from there.
CACHED = 100_000

#: Arcs that are kept resolved; beyond that the table is filled anew.
CACHED_ARCS = 200_000

#: Texts encoded and handed on together.
PART = 200


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + rest.index(b)) for b in range(256)]


class Automaton:
    """Gadgets of a merge list, and the transition table that is filled from them on use."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocabulary.values(), default=-1) + 1
        self.size = size
        self.born = [-1] * size
        self.left = [-1] * size
        self.right = [-1] * size
        self.cut: dict[int, int] = {}
        self.spelled = {}
        for token, i in vocabulary.items():
            self.spelled[i] = (token,)
        for time, (a, b) in enumerate(merges):
            self._gadget(vocabulary[a], vocabulary[b], vocabulary[a + b], time)
        # Labels by their symbols: all labels that start at a place are found in one walk. Each node holds the
        # (length, label) of those on the way to it, longest first.
        self.spelling: dict = {}
        for label, symbols in self.spelled.items():
            node = self.spelling
            for symbol in symbols:
                node = node.setdefault(symbol, {})
            node[None] = label
        del self.spelled
        nodes = [(self.spelling, 0, ())]
        while nodes:
            node, length, found = nodes.pop()
            if None in node:
                found = ((length, node[None]), *found)
            nodes += [(child, length + 1, found) for symbol, child in node.items() if symbol is not None]
            node[None] = found
        self.arcs: dict[int, bool] = {}

    def _gadget(self, a: int, b: int, t: int, time: int) -> None:
        self.cut.setdefault(a * self.size + b, time)
        if self.born[t] < 0:
            self.born[t], self.left[t], self.right[t] = time, a, b
            self.spelled[t] = self.spelled[a] + self.spelled[b]

    def has_arc(self, state: int, label: int) -> bool:
        """Whether arc ``label`` leaves the state after token ``state`` in the finished automaton."""
        key = state * self.size + label
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) >= CACHED_ARCS:
                self.arcs.clear()
            known = self.arcs[key] = self._resolved(state, label)
        return known

    def _resolved(self, state: int, label: int) -> bool:
        before = NO_TIME
        while True:
            if self.cut.get(state * self.size + label, NO_TIME) < before:
                return False
            if self.born[state] > self.born[label]:
                # The state inherits the arcs of its right part as they were before its gadget.
                before, state = self.born[state], self.right[state]
            elif self.born[label] >= 0:
                # The arc exists where its left part existed once its own gadget had cut.
                before, label = self.born[label] + 1, self.left[label]
            else:
                return True

    def path(self, symbols: list[str]) -> list[int]:
        """Arc labels of the one accepted path that spells the symbols.

        Longest label first. At most one path reaches a place, so a place that leads nowhere is
        never entered again and the search takes time in proportion to the word.
        """
        n, arcs, size, spelling = len(symbols), self.arcs, self.size, self.spelling
        labels, ends, untried, dead = [], [0], [], set()
        symbols = [*symbols, ""]
        while (at := ends[-1]) < n:
            if len(untried) < len(ends):
                node, k = spelling, at
                while (longer := node.get(symbols[k])) is not None:
                    node, k = longer, k + 1
                untried.append(iter(node[None]))
            for length, label in untried[-1]:
                if at + length in dead:
                    continue
                if labels:
                    arc = arcs.get(labels[-1] * size + label)
                    if not (self.has_arc(labels[-1], label) if arc is None else arc):
                        continue
                labels.append(label)
                ends.append(at + length)
                break
            else:
                dead.add(ends.pop())
                untried.pop()
                labels.pop()
        return labels


class Memory(dict):
    """Results of a function by text, in two generations of bounded size; long texts are not kept."""

    def __init__(self, function):
        super().__init__()
        self.function = function
        self.old: dict = {}

    def __missing__(self, text: str):
        found = self.old.get(text)
        if found is None:
            found = self.function(text)
        if len(text) <= 64:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[text] = found
        return found


class WordTokenizer:
    """Normalizer, pre-splitting and automaton of a lower-casing vocabulary with word ends."""

    def __init__(self, definition: str):
        with open(definition, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges)
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.label = {i: token for token, i in (model["vocab"] | self.special).items()}
        split = next(
            p["pattern"]["Regex"]
            for p in described["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        self.words = regex.compile(split)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.symbols = dict(enumerate(byte_symbols()))
        self.known_words = Memory(self._word)

    def _word(self, word: str) -> tuple[bytes, str]:
        """(ids as little-endian 32-bit integers, arc labels joined by blanks) of a pre-split word."""
        symbols = list(word.encode("utf-8").decode("latin-1").translate(self.symbols))
        symbols[-1] += self.end
        ids = self.automaton.path(symbols)
        return array("I", ids).tobytes(), " ".join([self.label[i] for i in ids])

    def _pieces(self, text: str) -> list[tuple[bytes, str]]:
        """:meth:`_word` of every word of a text without special tokens."""
        if not text.isascii():
            # Lower case goes letter by letter: the final sigma has no form of its own here.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return list(map(self.known_words.__getitem__, self.words.findall(text.lower())))

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids (packed) and decoded text of a whole text; null counts as empty."""
        if not text:
            return b"", ""
        if "<|" not in text:
            found = self._pieces(text)
        else:
            found = []
            for part in self.specials.split(text):
                special = self.special.get(part)
                found += self._pieces(part) if special is None else [(array("I", [special]).tobytes(), part)]
        return b"".join([ids for ids, _ in found]), " ".join([s for _, s in found])


def tokenizer(definition: str) -> WordTokenizer:
    """One automaton per worker, kept from task to task until other work drops it."""
    return worker_table(("bpe_automaton", definition), lambda: WordTokenizer(definition))


def encode(docs: DataFrame, definition: str, *, keep_ids: bool = True, keep_decoded: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, on demand, the
    packed ``ids`` and the ``decoded`` text.

    Ids are little-endian unsigned 32-bit integers. Decoding joins the labels of the arcs. A null text
    counts as empty: no ids and an empty decoded text. All columns of ``docs`` stay; columns with the
    names of new ones are replaced. ``definition`` must be readable on every executor.
    """
    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    kinds |= {"ids": pa.binary()} if keep_ids else {}
    kinds |= {"decoded": pa.string()} if keep_decoded else {}
    sql = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}

    def described(made: list[tuple[bytes, str]]) -> pa.Array:
        columns = {
            "n_tokens": [len(ids) // 4 for ids, _ in made],
            "ids_sha256": [hashlib.sha256(ids).hexdigest() for ids, _ in made],
            "decoded_sha256": [hashlib.sha256(text.encode("utf-8")).hexdigest() for _, text in made],
            "ids": [ids for ids, _ in made],
            "decoded": [text for _, text in made],
        }
        return pa.StructArray.from_arrays([pa.array(columns[n], t) for n, t in kinds.items()], list(kinds))

    @F.arrow_udf("struct<" + ",".join(f"{name}:{sql[kind]}" for name, kind in kinds.items()) + ">")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = tokenizer(definition)
        for batch in batches:
            # Handed on in small parts, so that a batch is never held whole in all forms.
            for k in range(0, len(batch), PART):
                yield described([tables.encode(text) for text in batch[k : k + PART].to_pylist()])

    held = [c for c in docs.columns if c not in kinds]
    # The input row is one struct, so that no name of it can clash with the new one.
    out = docs.select(F.struct(*held).alias("row"), encoded(F.col("text")).alias("encoded"))
    return out.select("row.*", *[F.col("encoded")[c].alias(c) for c in kinds])
