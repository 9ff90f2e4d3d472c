"""Token counts by a tokenizer that is compiled to two deterministic finite-state transducers.

The first reads characters. Its states are what is open (nothing, a run of letters, a run of other
marks, the beginning of a contraction) and its transitions say which of the last three characters
end a word. The second reads the words' bytes. Its state holds, for every place where a token that
is not yet complete may have begun, the trie node reached, the last token before that place and how
many tokens lie before it; a transition is annotated with the number of tokens that have become
certain, so the counts met along a word add up to its tokens. The last byte of a word is a symbol of
its own, as the vocabulary has tokens for word ends, and leads back to the start. States are made
when they are first met.

Text is read in lanes of equal length, all at once. A lane of the first transducer is run from every
state; the resulting state maps are composed by a parallel prefix scan, which gives each lane the
state it begins in. In the second, a lane's map is constant from its first word end on, whatever the
state before; so each lane is run from there, the scan hands the state at its end to the next lane,
and the piece before the first word end is read from that. A lane without any word end (a word of
hundreds of bytes) is read from its true state in the order of the text.
"""
from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from tokenizers import Tokenizer, normalizers

from tellmark.llm.common import documents, present, without

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048
#: Characters read at a time, and the length of a lane; results do not depend on them.
SLICE = 1 << 20
LANE = 256
#: Transitions and pairs kept by a worker before it starts with an empty machine again.
KEPT = 1 << 20
#: Ends a text; no code point.
END = 0x110000
#: Multiplier that spreads transitions over their table.
SPREAD = 0x9E3779B97F4A7C15
WORD = "[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordEnds:
    """The transducer of characters: which of them end a word."""

    def __init__(self, spec: dict, library: Tokenizer):
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        literals, words = pattern[: -len(WORD)].strip("|").split("|"), pattern[-len(WORD) :]
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if words != WORD or steps != ["NFC", "Replace", "Lowercase"] or not all(x[0] == "'" and x[1:].isalpha() for x in literals):
            raise ValueError("the tokenizer's normalizer or word pattern has another form than the one compiled here")
        self.library, self.literals = library, set(literals)
        letters = sorted({c for x in literals for c in x[1:]})
        self.classes = {"pad": 0, "L": 1, "N": 2, "S": 3, "O": 4, "'": 5} | {c: 6 + i for i, c in enumerate(letters)}
        prefixes = sorted({x[:i] for x in literals for i in range(1, len(x))})
        self.states = ["B", "L", "O", *prefixes]
        # Row by state, column by class: next state and the characters that end a word, as bits (1: this one, 2: the one before, 4: the one before that).
        self.next = np.zeros((len(self.states), len(self.classes)), np.uint8)
        self.ends = np.zeros_like(self.next)
        for i, state in enumerate(self.states):
            self.next[i, 0] = i
            for kind, k in list(self.classes.items())[1:]:
                to, self.ends[i, k] = self._step(state, kind)
                self.next[i, k] = self.states.index(to)
        self.kind = np.full(END + 1, 255, np.uint8)
        self.lower = np.arange(END + 1, dtype=np.uint32)
        self.kind[END] = self.classes["S"]
        #: Characters whose lower case is longer than one.
        self.longer = {c: library.normalizer.normalize_str(chr(c)) for c in range(0x80, END) if not 0xD800 <= c < 0xE000 and len(chr(c).lower()) > 1}

    def _step(self, state: str, kind: str) -> tuple[str, int]:
        if state[0] == "'":
            read = state + kind
            if len(kind) == 1 and read in self.literals:
                return "B", 1
            if len(kind) == 1 and read in self.states:
                return read, 0
            if len(state) > 1:  # the apostrophe was a word, the rest begins a run of letters
                to, ends = self._step("L", kind)
                return to, ends | 1 << len(state)
            state = "O"
        letter = kind == "L" or kind.isalpha() and kind.islower()
        if state == "L" and letter or state == "O" and kind in ("O", "'"):
            return state, 0
        before = 2 * (state != "B")
        if letter:
            return "L", before
        return {"N": ("B", before | 1), "S": ("B", before), "O": ("O", before), "'": ("'", before)}[kind]

    def learn(self, points: np.ndarray) -> None:
        """Class and lower case of characters met for the first time, as the library has them."""
        for c in np.unique(points[self.kind[points] == 255]).tolist():
            low = self.library.normalizer.normalize_str(chr(c))
            pieces = lambda text: [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
            kind = "L" if len(pieces(f"a{low}a")) == 1 else "O" if len(pieces(f"!{low}!")) == 1 else "N" if pieces(low) else "S"
            if len(low) != 1:
                raise ValueError(f"the lower case of U+{c:04X} has {len(low)} characters")
            self.lower[c], self.kind[c] = ord(low), self.classes.get(low, self.classes[kind])

    def run(self, kinds: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """Bits of word ends for every character, and the state after them."""
        n, width = len(kinds), len(self.classes)
        lanes = -(-n // LANE)
        steps = np.zeros((lanes, LANE), np.uint8)
        steps.ravel()[:n] = kinds
        steps = np.ascontiguousarray(steps.T)
        table = self.next.ravel()
        maps = np.tile(np.arange(len(self.states), dtype=np.uint8), (lanes, 1))
        for k in range(LANE):
            maps = table[maps.astype(np.intp) * width + steps[k][:, None]]
        hop = 1
        while hop < lanes:  # the prefix scan: maps[i] becomes the map of all lanes up to i
            maps[hop:] = np.take_along_axis(maps[hop:], maps[:-hop].astype(np.intp), 1)
            hop *= 2
        now = np.empty(lanes, np.intp)
        now[0], now[1:] = state, maps[:-1, state]
        ends = np.empty_like(steps)
        for k in range(LANE):
            at = now * width + steps[k]
            ends[k] = self.ends.ravel()[at]
            now = table[at].astype(np.intp)
        return ends.T.ravel()[:n], int(maps[-1, state])


class TokenSteps:
    """The transducer of bytes: states, transitions, and the tokens that become certain on them."""

    def __init__(self, spec: dict):
        model = spec["model"]
        suffix, vocabulary = model["end_of_word_suffix"] or "", model["vocab"]
        if model["type"] != "BPE" or not suffix or any(model[k] for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("the tokenizer's model has another form than the one compiled here")
        self.symbols = {}  # of each token: bytes, 256 more for the last of a word
        for b, c in enumerate(byte_letters()):
            self.symbols[vocabulary[c]], self.symbols[vocabulary[c + suffix]] = (b,), (b + 256,)
        self.single = {s[0]: t for t, s in self.symbols.items()}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            t = vocabulary[a + b]
            self.merges[vocabulary[a], vocabulary[b]] = rank, t
            self.symbols[t] = self.symbols[vocabulary[a]] + self.symbols[vocabulary[b]]
        self.children: dict[tuple[int, int], int] = {}
        self.token, self.inner = [-1], [True]
        for t, symbols in self.symbols.items():
            node = 0
            for x in symbols:
                if (node, x) not in self.children:
                    self.inner[node] = True
                    self.children[node, x] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = self.children[node, x]
            self.token[node] = t
        self.clear()

    def clear(self) -> None:
        self.pairs: dict[tuple[int, int], bool] = {}
        self.states = [((0, -1, 0),)]
        self.numbers = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self._table(1 << 16)

    def _table(self, size: int) -> None:
        """Transitions for whole arrays: open addressing by state and symbol."""
        self.keys = np.full(size, -1, np.int64)
        self.to, self.count = np.zeros(size, np.int32), np.zeros(size, np.int32)
        for key in self.steps:
            self._put(key)

    def _put(self, key: int) -> None:
        at = (key * SPREAD & (1 << 64) - 1) >> 64 - (len(self.keys).bit_length() - 1)
        while self.keys[at] >= 0:
            at = (at + 1) % len(self.keys)
        self.keys[at], (self.to[at], self.count[at]) = key, self.steps[key]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(SPREAD)
        return (mixed >> np.uint64(64 - (len(self.keys).bit_length() - 1))).astype(np.int64)

    def together(self, a: int, b: int) -> bool:
        """Whether merging leaves two tokens apart that follow each other."""
        if a < 0:
            return True
        if (a, b) not in self.pairs:
            tokens = [self.single[x] for x in self.symbols[a] + self.symbols[b]]
            while found := min(((*self.merges[p], k) for k, p in enumerate(zip(tokens, tokens[1:])) if p in self.merges), default=None):
                tokens[found[2] : found[2] + 2] = [found[1]]
            self.pairs[a, b] = tokens == [a, b]
        return self.pairs[a, b]

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """Next state, and the tokens that become certain."""
        key = state * 512 + symbol
        if key in self.steps:
            return self.steps[key]
        open_, last = [], None
        for node, before, n in self.states[state]:
            child = self.children.get((node, symbol))
            if child is None:
                continue
            t = self.token[child]
            if t >= 0 and last is None and self.together(before, t):
                last = t, n + 1
            if self.inner[child]:
                open_.append((child, before, n))
        if symbol >= 256:
            self.steps[key] = 0, last[1]
        else:
            open_.append((0, *last))
            certain = min(n for *_, n in open_)
            found = tuple((node, before, n - certain) for node, before, n in open_)
            self.steps[key] = self.number(found), certain
        if 2 * len(self.steps) > len(self.keys):
            self._table(4 * len(self.keys))
        else:
            self._put(key)
        return self.steps[key]

    def number(self, state: tuple) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
        return self.numbers[state]

    def take(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`step` for arrays."""
        keys = states.astype(np.int64) * 512 + symbols
        at = self._slots(keys)
        found = self.keys[at]
        off = np.flatnonzero(found != keys)
        while len(off):
            new = off[found[off] < 0]
            if len(new):
                for key in np.unique(keys[new]).tolist():
                    self.step(*divmod(key, 512))
                return self.take(states, symbols)
            at[off] = (at[off] + 1) % len(self.keys)
            found[off] = self.keys[at[off]]
            off = off[found[off] != keys[off]]
        return self.to[at], self.count[at]

    def _lanes(self, steps: np.ndarray, states: np.ndarray, first: np.ndarray, end: np.ndarray, counts: np.ndarray) -> None:
        """Run each lane over its places from `first` up to `end`; states and counts are filled in."""
        for k in range(int(first.min()), int(end.max())):
            on = np.flatnonzero((first <= k) & (k < end))
            if len(on):
                states[on], counts[k, on] = self.take(states[on], steps[k, on])

    def run(self, symbols: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """Tokens that become certain at every byte, and the state after them."""
        n = len(symbols)
        if not n:
            return np.empty(0, np.int64), state
        lanes = -(-n // LANE)
        length = np.full(lanes, LANE)
        length[-1] = n - LANE * (lanes - 1)
        steps = np.zeros((lanes, LANE), np.int32)
        steps.ravel()[:n] = symbols
        has_end = steps >= 256
        after = np.where(has_end.any(1), has_end.argmax(1) + 1, LANE + 1)  # place after the first word end
        steps = np.ascontiguousarray(steps.T)
        counts = np.zeros((LANE, lanes), np.int64)
        exits = np.zeros(lanes, np.int32)
        constant = after <= LANE
        self._lanes(steps, exits, after, np.where(constant, length, 0), counts)
        for i in np.flatnonzero(~constant).tolist():
            now = int(exits[i - 1]) if i else state
            for k, x in enumerate(steps[: length[i], i].tolist()):
                now, counts[k, i] = self.step(now, x)
            exits[i] = now
        entries = np.roll(exits, 1)
        entries[0] = state
        self._lanes(steps, entries, np.zeros(lanes, int), np.where(constant, after, 0), counts)
        return counts.T.ravel()[:n], int(exits[-1])


class Compiled:
    """Both transducers of a tokenizer file's content, and the strings it never cuts."""

    def __init__(self, content: str):
        spec = json.loads(content)
        self.library, self.nfc = Tokenizer.from_str(content), normalizers.NFC()
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("the tokenizer's special strings have options that are not compiled here")
        self.words, self.tokens = WordEnds(spec, self.library), TokenSteps(spec)

    def segments(self, text: str) -> tuple[list[str], int]:
        """The text between special strings, and how many of them there are."""
        parts, found = [], 0
        rest = text
        while at := [(i, -len(s), s) for s in self.special if (i := rest.find(s)) >= 0]:
            i, _, s = min(at)
            parts.append(rest[:i])
            rest, found = rest[i + len(s) :], found + 1
        parts.append(rest)
        return [p if p.isascii() or unicodedata.is_normalized("NFC", p) else self.nfc.normalize_str(p) for p in parts], found

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        total = np.zeros(len(texts), np.int64)
        owner: list[int] = []

        def slices() -> Iterator[np.ndarray]:
            held, size = [], 0
            for i, text in enumerate(texts):
                parts, special = self.segments(text)
                total[i] += special
                for part in parts:
                    owner.append(i)
                    if any(chr(c) in part for c in self.words.longer):
                        part = part.translate(self.words.longer)
                    for start in range(0, max(1, len(part)), SLICE):
                        held.append(np.frombuffer(part[start : start + SLICE].encode("utf-32-le"), np.uint32))
                        size += len(held[-1])
                        if size >= SLICE:
                            yield np.concatenate(held)
                            held, size = [], 0
                    held.append(np.array([END], np.uint32))
            yield np.concatenate([*held, np.full(2, END, np.uint32)])

        sums = np.concatenate([*self._read(slices())])[: len(owner)]
        np.add.at(total, owner, np.diff(sums, prepend=0))
        return total

    def _read(self, slices: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
        """Tokens of the stream up to every END in it; two characters are always held back, as a
        word end may become known two characters later."""
        open_, inside, sofar = 0, 0, 0
        points, ends = np.empty(0, np.uint32), np.empty(0, bool)
        for new in slices:
            if len(self.tokens.steps) + len(self.tokens.pairs) > KEPT:
                state = self.tokens.states[inside]
                self.tokens.clear()
                inside = self.tokens.number(state)
            self.words.learn(new)
            kinds = self.words.kind[new]
            bits, open_ = self.words.run(kinds, open_)
            held = len(points)
            points, ends = np.concatenate([points, new]), np.concatenate([ends, np.zeros(len(new), bool)])
            for back in range(3):
                at = np.flatnonzero(bits & (1 << back)) + held - back
                ends[at] = True
            ready, (points, ends_now), ends = points[:-2], (points[-2:], ends[:-2]), ends[-2:]
            ink = self.words.kind[ready] != self.words.classes["S"]
            low = self.words.lower[ready]
            width = 1 + (low >= 0x80).astype(np.int64) + (low >= 0x800) + (low >= 0x10000)
            width[~ink] = 0
            data = low[ink].astype("<u4").tobytes().decode("utf-32-le").encode()
            symbols = np.frombuffer(data, np.uint8).astype(np.int32)
            upto = np.cumsum(width)
            symbols[upto[ends_now & ink] - 1] += 256
            counts, inside = self.tokens.run(symbols, inside)
            sums = np.concatenate([[0], np.cumsum(counts)]) + sofar
            sofar = int(sums[-1])
            yield sums[upto[ready == END]]


@functools.lru_cache(maxsize=2)
def _compiled(content: str) -> Compiled:
    return Compiled(content)


def _count(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    machine = _compiled(shared.value)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        step = max(1, int(batch.num_rows * SLICE // max(1, texts.nbytes)))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            n = machine.counts(part.column(part.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n)], names=[*part.schema.names[:-1], "n_tokens"])


def count_tokens(docs: DataFrame, text_col: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """The input with `n_tokens bigint`, which replaces a column of that name.

    No row is moved; each row is read alone, so repeated rows get equal counts. Null, empty and
    blank texts have no tokens. A very long text is read in slices that carry the state along, so
    memory is bounded by the text itself. Strings of special tokens inside a text are one token each
    (the library's default). The tokenizer file is read once, on the driver, and sent along.
    """
    with open(tokenizer, encoding="utf-8") as f:
        content = f.read()
    Compiled(content)  # a file of another form fails here
    rows = docs.select(*without(docs, "n_tokens"), present(F.col(text_col)).alias("n_tokens"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType(), False)])
    shared = docs.sparkSession.sparkContext.broadcast(content)  # a vocabulary, not data
    return rows.mapInArrow(functools.partial(_count, shared=shared), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they are more than LIMIT."""
    rows = documents(spark, sf_dir).select("doc_id", F.octet_length(present(F.col("text"))).cast("bigint").alias("n_bytes"), "text")
    return count_tokens(rows).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
