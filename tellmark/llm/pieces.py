"""Encoding and decoding with the pieces of a SentencePiece model.

The distinct marked words of a batch are sorted, which lays their trie out depth-first: a word
shares the forward states of its common prefix with the word before it, and only the rest is
computed. The vocabulary is a merge (BPE) vocabulary, so the best path is the one that merging in
score order would give, not the one with the largest sum of scores. That path has the same optimal
substructure: its last piece at each prefix is unique, and it extends a shorter prefix exactly when
the two neighbouring pieces alone would not be merged otherwise. A forward state is therefore the
last piece of its prefix.
"""
from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tellmark.llm.common import documents, present

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: A marked word: its marks, then everything up to the next mark.
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CUT = re.compile(f"(?<=[^{MARK}]){MARK}")
#: Words kept encoded between batches of a worker, and characters encoded at once.
CACHED, SEGMENT = 1 << 18, 1 << 22


class Vocabulary:
    """Pieces of a model, and the forward pass over sorted words."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: str):
        self.pieces, self.scores, self.kinds = pieces, scores, kinds
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k in "nx"}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "b"}
        self.unknown = kinds.index("u")
        self.lengths = [len(p) for p in pieces]
        # Every ending of a piece, with the piece's id where the ending is a whole piece, else -1.
        self.endings = dict.fromkeys((p[i:] for p in self.ids for i in range(len(p))), -1)
        self.endings.update({p: i for p, i in self.ids.items() if kinds[i] == "n"})
        self.raw = [
            bytes([int(p[3:5], 16)]) if k == "b" else p.replace(MARK, " ").encode() if k in "nx" else b"" for p, k in zip(pieces, kinds)]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor
        m = SentencePieceProcessor(model_file=path)
        n = m.vocab_size()
        kind = lambda i: "b" if m.is_byte(i) else "u" if m.is_unknown(i) else "c" if m.is_control(i) or m.is_unused(i) else "n"
        own = cls([m.id_to_piece(i) for i in range(n)], [m.get_score(i) for i in range(n)], "".join(map(kind, range(n))))
        # Marked x: pieces whose own text is merged into something else, so that no text gives them.
        kinds = [k if k != "n" or own.merged(p) == [p] else "x" for p, k in zip(own.pieces, own.kinds)]
        return cls(own.pieces, own.scores, "".join(kinds))

    def __reduce__(self):
        return Vocabulary, (self.pieces, self.scores, self.kinds)

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best-scored neighbours, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                j = self.ids.get(parts[i] + parts[i + 1])
                if j is not None and (best is None or self.scores[j] > best):
                    best, at = self.scores[j], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, i: int, j: int) -> bool:
        """Whether pieces i and j stay apart when their texts stand next to each other."""
        a, b = self.pieces[i], self.pieces[j]
        if len(self.fits) > 8 * CACHED:
            self.fits.clear()
        ok = self.fits[i << 32 | j] = self.merged(a + b) == [a, b]
        return ok

    def encode_words(self, words: list[str]) -> None:
        """Add distinct words, sorted, to `known`, each with its ids as 32-bit numbers."""
        endings, lengths, fits, follows, known = self.endings.get, self.lengths, self.fits.get, self.follows, self.known
        last, before = [-1], ""  # per prefix length its last piece; -1: none, or a character without piece
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                found, start = -1, end - 1
                while start >= 0:
                    j = endings(word[start:end])
                    if j is None:
                        break
                    if j >= 0:
                        i = last[start]
                        if i < 0:
                            found = j
                            break
                        ok = fits(i << 32 | j)
                        if follows(i, j) if ok is None else ok:
                            found = j
                            break
                    start -= 1
                last.append(found)
            before, end, out = word, len(word), []
            while end:
                j = last[end]
                if j < 0:
                    raw = word[end - 1].encode("utf-8", "replace")
                    out += [self.bytes.get(b, self.unknown) for b in reversed(raw)] if self.bytes else [self.unknown]
                    end -= 1
                else:
                    out.append(j)
                    end -= lengths[j]
            out.reverse()
            known[word] = array("i", out).tobytes()

    def segments(self, text: str) -> Iterator[list[str]]:
        """The marked words, some million characters at a time."""
        marked = MARK + text.replace(" ", MARK) if text else ""
        start = 0
        while start < len(marked):
            cut = CUT.search(marked, start + SEGMENT) if len(marked) - start > SEGMENT else None
            stop = cut.start() if cut else len(marked)
            yield WORD.findall(marked, start, stop)
            start = stop

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; the words of all texts are encoded together."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        pending, size = [], 0

        def settle() -> None:
            if len(self.known) > CACHED:  # words not met again since the last time are forgotten
                self.known, self.older = {}, self.known
            new = set().union(*[w for _, w in pending]).difference(self.known)
            again = new.intersection(self.older)
            self.known.update((w, self.older[w]) for w in again)
            self.encode_words(sorted(new - again))
            for k, words in pending:
                parts[k].append(np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32))
            pending.clear()

        for k, text in enumerate(texts):
            for words in self.segments(text):
                pending.append((k, words))
                size += len(words)
                if size > 1 << 19:
                    settle()
                    size = 0
        if pending:
            settle()
        return [np.concatenate(p) if p else np.empty(0, np.int32) for p in parts]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: bytes are joined and read as UTF-8, control ids give nothing."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def _on_worker(shared) -> Vocabulary:
    return shared.value


def _encode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    vocabulary = _on_worker(shared)
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            found = vocabulary.encode(part.column(part.num_columns - 1).to_pylist())
            offsets = np.zeros(len(found) + 1, np.int32)
            np.cumsum([len(x) for x in found], out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found) if found else np.empty(0, np.int32)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=[*part.schema.names[:-1], "piece_ids"])


def _decode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    vocabulary = _on_worker(shared)
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            part = batch.slice(start, 1000)
            ids = part.column(part.num_columns - 1)
            values, ends = ids.flatten().to_numpy(), np.cumsum([n or 0 for n in ids.value_lengths().to_pylist()])
            text = [None if null else vocabulary.decode(x.tolist()) for x, null in zip(np.split(values, ends[:-1]), ids.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(text, pa.string())], names=[*part.schema.names[:-1], "decoded"])


def encode(docs: DataFrame, text_col: str = "text", model: str = MODEL) -> DataFrame:
    """The input with `piece_ids array<int>`, which replaces a column of that name. Null and empty
    texts have no ids. No row is moved. The model is read once, on the driver, and sent along."""
    keep = [c for c in docs.columns if c.lower() != "piece_ids"]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], present(F.col(text_col)).alias("piece_ids"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("piece_ids", T.ArrayType(T.IntegerType(), False))])
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(model))  # a vocabulary, not data
    return rows.mapInArrow(functools.partial(_encode, shared=shared), schema)


def decode(df: DataFrame, ids_col: str = "piece_ids", model: str = MODEL) -> DataFrame:
    """The input with `decoded string`, which replaces a column of that name; null ids give null."""
    keep = [c for c in df.columns if c.lower() != "decoded"]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(ids_col).alias("decoded"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("decoded", T.StringType())])
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary.read(model))
    return rows.mapInArrow(functools.partial(_decode, shared=shared), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text back (marks read as spaces)."""
    rows = documents(spark, sf_dir).select("doc_id", F.length(present(F.col("text"))).alias("n_chars"),
                                           F.sha2(F.replace(present(F.col("text")), F.lit(MARK), F.lit(" ")), 256).alias("sha"), "text")
    ids = encode(rows).select("doc_id", "n_chars", "sha", "piece_ids")
    return decode(ids).select(
        "doc_id", "n_chars", F.size("piece_ids").cast("bigint").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("ids_hash"), F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip"))
