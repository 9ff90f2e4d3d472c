"""Personal data: e-mail addresses, IP addresses, card numbers and phone numbers.

Exact patterns give the base spans. A character tagger (bidirectional LSTM with a CRF), trained on
the base spans of a bounded sample of windows, adds spans that the patterns do not describe. Every
kind of span holds a digit or an @, so the tagger reads the overlapping windows that hold one;
elsewhere every character is outside. The scores of overlapping windows are averaged, the nearer to
a window's middle the heavier, and each stretch of windows is decoded in one go, so a span that
crosses windows comes out whole and once.
"""
from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tellmark.llm import tagger
from tellmark.llm.common import documents, present, without

KINDS = ["email", "ip", "card", "phone"]
#: Windows of the sample that the tagger is trained on, with and without spans; a seeded hash chooses.
SAMPLE = 1200
WINDOW, STRIDE = 64, 32
#: Mean score by which an added span must beat "outside", and its least length.
MARGIN, LEAST = 4.0, 6

# A run of digits or local characters is entered at its start only; inside it nothing new can match.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[\d@\uFF20]")  # any digit, also a fullwidth @
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches from left to right; the local part reaches back from its @ as far as it can."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind number, start, end) of what passes, by kind and start; and the same of the matches that fail."""
    if not TRIGGER.search(text):
        return [], []
    good, bad = [(0, *m) for m in emails(text)], []
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        for m in pattern.finditer(text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            ok = (all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")) if kind == 1
                  else 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15)
            (good if ok else bad).append((kind, *m.span()))
    return good, bad


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


# -- training --------------------------------------------------------------------------------------------

def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @."""
    found, nxt = [], 0
    m = TRIGGER.search(text)
    while m:
        block = m.start() // STRIDE
        for b in (block - 1, block):
            if b >= nxt:
                found.append(b * STRIDE)
                nxt = b + 1
        m = TRIGGER.search(text, (block + 1) * STRIDE)
    return found


def window_tags(spans: list[tuple[int, int, int]], start: int) -> np.ndarray:
    """Per character of a window: 0 outside, 2k + 1 where a span of kind k begins, 2k + 2 inside it."""
    tags = np.zeros(WINDOW, np.int64)
    for kind, s, e in sorted(spans, key=lambda x: (x[0] == 2, x)):  # a card inside a phone number yields
        a, b = max(s, start) - start, min(e, start + WINDOW) - start
        if a < b and not tags[a:b].any():
            tags[a:b] = 2 * kind + 2
            if s >= start:
                tags[a] = 2 * kind + 1
    return tags


def window_ids(text: str, start: int) -> np.ndarray:
    ids = np.full(WINDOW, tagger.PAD, np.int64)
    part = tagger.char_ids(text[start : start + WINDOW])
    ids[: len(part)] = part
    return ids


EXAMPLE = "labelled int, place bigint, window string, tags binary"


def _examples(batches: Iterator[pa.RecordBatch], seed: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The windows of a batch with the smallest seeded hashes; at most `limit` with and without spans."""
    for batch in batches:
        rows: dict[int, list] = {0: [], 1: []}
        for text in batch.column(0).to_pylist():
            spans, _ = base_spans(text)
            for start in window_starts(text):
                tags, part = window_tags(spans, start), text[start : start + WINDOW]
                place = int.from_bytes(hashlib.blake2b(f"{seed}:{start}:{part}".encode("utf-8", "replace"), digest_size=7).digest(), "big")
                kept = rows[int(tags.any())]
                kept.append((int(tags.any()), place, part, tags.astype(np.int8).tobytes()))
                if len(kept) > 4 * limit:
                    kept[:] = sorted(kept)[:limit]
        out = [x for kept in rows.values() for x in sorted(kept)[:limit]]
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int64(), pa.string(), pa.binary()])],
                                         names=["labelled", "place", "window", "tags"])


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE, epochs: int = 14, seed: int = 3) -> dict[str, np.ndarray]:
    """Tagger weights from at most `sample` windows with a base span and as many without."""
    found = docs.select(present(F.col(text_col)).alias("text")).mapInArrow(functools.partial(_examples, seed=seed, limit=sample), EXAMPLE)
    rows = [r for y in (1, 0) for r in found.filter(F.col("labelled") == y).orderBy("place", "window").limit(sample).collect()] if sample else []
    ids = np.array([window_ids(r.window, 0) for r in rows]).reshape(-1, WINDOW)
    tags = np.array([np.frombuffer(bytes(r.tags), np.int8) for r in rows], np.int64).reshape(-1, WINDOW)
    return tagger.train(ids, tags, 2 * len(KINDS) + 1, epochs=epochs, seed=seed)


# -- finding ---------------------------------------------------------------------------------------------

NEARNESS = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def stretches(starts: list[int]) -> list[list[int]]:
    """Window starts, grouped where windows overlap."""
    out: list[list[int]] = []
    for s in starts:
        if out and s - out[-1][-1] < WINDOW:
            out[-1].append(s)
        else:
            out.append([s])
    return out


def tagged_spans(w: dict[str, np.ndarray], texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
    """(kind, start, end, mean margin) that the tagger finds in each text."""
    out: list[list] = [[] for _ in texts]
    runs = [(i, group) for i, t in enumerate(texts) for group in stretches(window_starts(t))]
    runs.sort(key=lambda x: len(x[1]))
    start = 0
    while start < len(runs):  # some stretches of like length at once
        longest = len(runs[start][1])
        stop = start + 1
        while stop < len(runs) and len(runs[stop][1]) <= longest + longest // 4 and (stop - start + 1) * len(runs[stop][1]) <= 512:
            stop += 1
        part = runs[start:stop]
        start = stop
        ids = np.array([window_ids(texts[i], s) for i, group in part for s in group])
        scores = np.concatenate([tagger.emissions(w, ids[k : k + 512])[0] for k in range(0, len(ids), 512)])
        steps = max(group[-1] - group[0] for _, group in part) + WINDOW
        total = np.zeros((len(part), steps, scores.shape[2]), np.float32)
        weight = np.zeros((len(part), steps, 1), np.float32)
        k = 0
        for r, (_, group) in enumerate(part):
            for s in group:
                a = s - group[0]
                total[r, a : a + WINDOW] += scores[k] * NEARNESS[:, None]
                weight[r, a : a + WINDOW, 0] += NEARNESS
                k += 1
        mean = total / np.maximum(weight, 1)
        tags = tagger.decode(mean, w["moves"], w["first"])
        for r, (i, group) in enumerate(part):
            at = 0
            size = min(group[-1] + WINDOW, len(texts[i])) - group[0]
            while at < size:
                tag = int(tags[r, at])
                if tag % 2 == 1:
                    end = at + 1
                    while end < size and tags[r, end] == tag + 1:
                        end += 1
                    inside = np.arange(at, end)
                    gain = mean[r, inside, tags[r, at:end]] - mean[r, inside, 0]
                    out[i].append((tag // 2, group[0] + at, group[0] + end, float(gain.mean())))
                    at = end
                else:
                    at += 1
    return out


def found_spans(w: dict[str, np.ndarray], texts: list[str], margin: float = MARGIN) -> list[tuple[list, list]]:
    """Per text its base spans, and what the tagger adds: sure enough, long enough, holding a digit or
    an @, apart from all base spans, and not just what its kind's own pattern matched and refused."""
    out = []
    for text, tagged in zip(texts, tagged_spans(w, texts)):
        good, bad = base_spans(text)
        refused = set(bad)
        added = [(k, s, e) for k, s, e, gain in tagged
                 if gain >= margin and e - s >= LEAST and TRIGGER.search(text, s, e)
                 and (k, s, e) not in refused and not any(s < b and a < e for _, a, b in good)]
        out.append((good, added))
    return out


FOUND = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]
FOUND_TYPES = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]


def _find(batches: Iterator[pa.RecordBatch], shared, margin: float) -> Iterator[pa.RecordBatch]:
    w = shared.value
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            rows = []
            for good, added in found_spans(w, part.column(part.num_columns - 1).to_pylist(), margin):
                counts = [sum(k == kind for k, _, _ in good) for kind in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(as_text(good).encode()).hexdigest(), as_text(good + added), len(added)))
            columns = list(zip(*rows)) or [[]] * len(FOUND)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array(c, t) for c, t in zip(columns, FOUND_TYPES)]],
                                             names=[*part.schema.names[:-1], *FOUND])


def find_personal_data(docs: DataFrame, weights: dict[str, np.ndarray], text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """The input with counts of base spans by kind, base_sha256, spans (base and added) and n_added;
    columns of these names are replaced. Offsets count code points, ends are exclusive. Null and
    empty texts have no spans. Nothing is shuffled."""
    rows = docs.select(*without(docs, *FOUND), present(F.col(text_col)).alias("spans"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema = (kept + ", " if kept else "") + "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # a few thousand numbers
    return rows.mapInArrow(functools.partial(_find, shared=shared, margin=margin), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return find_personal_data(docs, fit(docs)).select("doc_id", *FOUND)
