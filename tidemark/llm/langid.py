"""Languages of documents and of their paragraphs: multinomial naive Bayes over hashed character n-grams.

The model is fitted on a bounded sample of labelled documents (at most SAMPLE_DOCS per language, by hash). Labels may be wrong and
documents mixed: after a first fit the sample's paragraphs are labelled by the model itself, and it is fitted again. The matrix of
log-probabilities, buckets times languages, is broadcast once; MOST_LANGUAGES bounds it at 64 MB, longer lists of languages are refused. Scoring is done in numpy over all paragraphs of an
Arrow batch at once: n-grams are hashed from code points, their rows of the matrix are gathered and summed per paragraph.

Paragraphs are what lies between runs of blank lines, numbered from 0. A paragraph is prose if, markup taken away, it holds a sentence.
The document's language is that of the most characters of its prose paragraphs.

Edge cases: null and blank texts and texts without prose have no language (null, confidence 0); ties go to the language that comes first in the
document; texts are read whole, whatever their length; a label that names no known language counts as missing; without any labelled text no
document gets a language; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

GRAMS, BUCKETS, SAMPLE_DOCS, REFITS, MOST_LANGUAGES = (3, 4), 1 << 16, 400, 2, 256
#: A posterior is tempered to this many n-grams, so that long paragraphs don't all have confidence 1.
TEMPER = 40.0

#: Characters scored at a time.
CHUNK = 1 << 17
#: Code points that count as letters (after lower()), and the line break; higher ones are letters.
LETTERS = np.array([c == 10 or (chr(c).isalpha() and c < 0x2000) or 0x2070 <= c for c in range(0x2100)])

BREAK = re.compile(r"\n[^\S\n]*\n\s*")
# Inner templates, tables, comments, references, files and categories, bare links
MARKUP = re.compile(r"\{\{[^{}]*\}\}|<!--.*?-->|<ref[^>/]*/>|<ref[^>]*>.*?</ref>|<[^<>]*>|\[\[[^\[\]|:]*:[^\[\]]*\]\]|\[https?://[^\]\s]*[^\]]*\]|https?://\S+|__[A-Z]+__", re.S)
LINK = re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]")
TABLE = re.compile(r"\{\|.*?\|\}|^[ \t]*[|!].*$|^[ \t]*=+.*=+[ \t]*$|^[ \t]*#\s*\w+[ \t]*\[\[.*$", re.S | re.M)
TABLE_START = re.compile(r"\{\|.*?(\n\|\}|\Z)", re.S)
LINES = re.compile(r"^[ \t]*(?:[|!].*|=+.*=+[ \t]*|#\s*\w+[ \t]*\[\[.*)$", re.M)
#: A sentence: an upper-case letter, at least two more words, and a stop after a letter, digit or closing mark.
SENTENCE = re.compile(r"[^\W\d_a-zа-яßà-öø-ÿ][^.!?]*\s\S[^.!?]*\s\S[^.!?]*[\w)\]»”“\"'%]\s*[.!?…](?:\s|$|[\"»”)\[<(])")


def paragraphs(text: str) -> list[str]:
    """Pieces of a text between runs of blank lines."""
    return BREAK.split(text)


def prose(paragraph: str) -> str:
    """The paragraph's running text without markup, or '' if it holds no sentence."""
    p = paragraph
    first = p.lstrip()[:2]
    if not first or (first[0] == "=" and "\n" not in p.strip()):
        return ""
    if "{|" in p:
        p = TABLE_START.sub(" ", p)
    if "{" in p or "<" in p or "[" in p or "__" in p or "http" in p:
        while (q := MARKUP.sub(" ", p)) != p:
            p = q
        p = LINK.sub(r"\1", p)
    if first[0] in "|!=#{" or "\n" in p:
        p = LINES.sub(" ", p)
    p = p.replace("'''", "").replace("''", "").strip()
    return p if SENTENCE.search(p) else ""


def hashed_grams(texts: list[str], buckets: int = BUCKETS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-grams: (bucket of every n-gram, where each text's n-grams begin). Digits and marks count as blanks, runs of blanks as one."""
    cp = np.frombuffer("\n".join(texts).lower().encode("utf-32-le"), dtype=np.uint32)
    letter = LETTERS[np.minimum(cp, len(LETTERS) - 1)]
    cp = np.where(letter, cp, np.uint32(32))
    keep = np.empty(len(cp), dtype=bool)
    keep[:1] = True
    np.logical_or(letter[1:], letter[:-1], out=keep[1:])
    x = cp[keep]
    ends = np.append(np.flatnonzero(x == 10), len(x))
    out, h = [], np.full(len(x), 2166136261, dtype=np.uint32)
    for n in range(1, max(GRAMS) + 1):
        h = (h[: len(x) - n + 1] ^ x[n - 1 :]) * np.uint32(16777619)
        h ^= h >> np.uint32(15)
        if n in GRAMS:
            # An n-gram that reaches over a line break is none; those lie at the last n - 1 places of a text and on the break
            inside = np.ones(len(h), dtype=bool)
            for j in range(n):
                at = ends - j
                inside[at[(at >= 0) & (at < len(h))]] = False
            starts = np.concatenate([[0], ends[:-1] + 1])
            upto = np.concatenate([[0], np.cumsum(inside)])
            out.append(((h[inside] & np.uint32(buckets - 1)), upto[np.minimum(starts, len(h))]))
    return out


def chunks(texts: list[str]) -> Iterator[slice]:
    """Stretches of texts of about CHUNK characters; a longer text is one of its own."""
    first = size = 0
    for at, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield slice(first, at)
            first, size = at, 0
        size += len(t)
    if first < len(texts):
        yield slice(first, len(texts))


def scores(texts: list[str], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages summed log-probabilities, n-grams per text). Texts go through in chunks that stay in the processor's cache."""
    total, n = np.zeros((len(texts), matrix.shape[1])), np.zeros(len(texts))
    for part in chunks(texts):
        for grams, starts in hashed_grams(texts[part], len(matrix)):
            counts = np.diff(np.append(starts, len(grams)))
            some = counts > 0
            if len(grams):
                total[part][some] += np.add.reduceat(matrix.take(grams, axis=0), starts[some], axis=0)
            n[part] += counts
    return total, n


def _texts_of(pdf: pd.DataFrame) -> tuple[list[str], list[tuple[int, int, int]]]:
    """Prose of all paragraphs of a batch, and for each (row, paragraph number, characters)."""
    texts, where = [], []
    for row, text in enumerate(pdf["text"]):
        if not text:
            continue
        for k, p in enumerate(paragraphs(text)):
            if t := prose(p):
                texts.append(t.replace("\n", " "))
                where.append((row, k, len(p)))
    return texts, where


def _count(matrix: np.ndarray | None, n_langs: int):
    """Per partition: n-grams of each bucket and language; with a matrix, paragraphs count for the language it gives them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((n_langs, BUCKETS))
        for pdf in batches:
            texts, where = _texts_of(pdf)
            if not texts:
                continue
            if matrix is None:
                lang = pdf["label"].to_numpy()[[w[0] for w in where]].astype(np.int64)
            else:
                lang = scores(texts, matrix)[0].argmax(axis=1)
            for part in chunks(texts):
                for grams, starts in hashed_grams(texts[part]):
                    at = np.repeat(lang[part], np.diff(np.append(starts, len(grams)))) * BUCKETS + grams
                    sums += np.bincount(at, minlength=n_langs * BUCKETS).reshape(n_langs, BUCKETS)
        for k in range(n_langs):
            at = np.flatnonzero(sums[k])
            yield pd.DataFrame({"lang": k, "bucket": at, "c": sums[k][at].astype(np.int64)})

    return run


def label_index(docs: DataFrame, lang_codes: DataFrame, lang: str = "lang") -> tuple[DataFrame, list[str]]:
    """docs with label (number of the language its label names in any notation, null for none) and the codes in order."""
    rows = lang_codes.where("lang_code is not null").orderBy("lang_code").limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    codes = [r["lang_code"] for r in rows]
    named = {}
    for i, r in enumerate(rows):
        for c in r:
            if c:
                named[c.strip().lower()] = i
    key = F.lower(F.regexp_replace(F.col(lang), r"^\s+|\s+$", ""))
    lookup = F.create_map(*[F.lit(x) for kv in named.items() for x in kv])
    return docs.withColumn("label", F.coalesce(F.try_element_at(lookup, key), F.try_element_at(lookup, F.regexp_extract(key, r"^([a-z]{2,3})[-_][a-z0-9]+", 1)))), codes


def fit(docs: DataFrame, codes: list[str], sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-probabilities, buckets x languages, from at most about sample_docs labelled documents of each language. docs: doc_id, text, label."""
    n = {r[0]: r[1] for r in docs.where("label is not null").groupBy("label").count().collect()}
    spread = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for k, v in sorted(n.items()) for x in (k, int(1_000_000 * min(1.0, sample_docs / v)))]) if n else F.create_map(F.lit(0), F.lit(0))
    sample = materialize(docs.select("doc_id", "text", "label").where(F.col("label").isNotNull() & (spread < F.try_element_at(share, F.col("label")))).select("text", "label").repartition(8))
    matrix = None
    for _ in range(1 + REFITS):
        counts = sample.mapInPandas(_count(matrix, len(codes)), "lang int, bucket int, c long").groupBy("lang", "bucket").agg(F.sum("c").alias("c")).toPandas()
        table = np.zeros((BUCKETS, len(codes)))
        table[counts["bucket"].to_numpy(dtype=int), counts["lang"].to_numpy(dtype=int)] = counts["c"].to_numpy()
        if not table.any():
            return np.zeros((BUCKETS, len(codes)), dtype=np.float32)
        smooth = table + 0.05
        matrix = np.log(smooth / smooth.sum(axis=0))
    return matrix.astype(np.float32)


def _classify(matrix, codes: list[str]):
    """matrix: a broadcast variable."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = matrix.value
        for pdf in batches:
            texts, where = _texts_of(pdf) if m.any() else ([], [])
            total, n = scores(texts, m)
            best = total.argmax(axis=1) if len(texts) else np.zeros(0, int)
            if len(texts):
                z = total / np.maximum(n, 1)[:, None] * np.minimum(n, TEMPER)[:, None]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                sure = z.max(axis=1) / z.sum(axis=1)
            rows: list[list[tuple[int, int, int, float]]] = [[] for _ in range(len(pdf))]
            for (row, k, chars), b, s in zip(where, best, sure if len(texts) else (), strict=True):
                rows[row].append((k, chars, int(b), float(s)))
            out = []
            for doc, label, segs in zip(pdf["doc_id"], pdf["label"], rows, strict=True):
                chars: dict[int, int] = {}
                for _, c, b, _ in segs:
                    chars[b] = chars.get(b, 0) + c
                main = max(chars, key=chars.get) if chars else None
                weight = sum(c for _, c, _, _ in segs)
                conf = sum(c * s for _, c, b, s in segs if b == main) / weight if weight else 0.0
                wrong = main is not None and not label == main
                out.append((doc, -1, codes[main] if main is not None else None, conf, wrong))
                out.extend((doc, k, codes[b], s, True) for k, _, b, s in segs if b != main)
            yield pd.DataFrame(out, columns=["doc_id", "seg_no", "lang_code", "confidence", "departs"])

    return run


def languages(docs: DataFrame, matrix: np.ndarray, codes: list[str]) -> DataFrame:
    """doc_id, seg_no, lang_code, confidence, departs: a row of seg_no -1 for every document (departs: its label is missing or another),
    and one for each prose paragraph in another language than the document's. One narrow stage; nothing is shuffled."""
    return docs.select("doc_id", "text", "label").mapInPandas(_classify(docs.sparkSession.sparkContext.broadcast(matrix), codes), "doc_id long, seg_no long, lang_code string, confidence double, departs boolean")
