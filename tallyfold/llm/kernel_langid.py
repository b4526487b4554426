"""Language identification with a string kernel.

The kernel of two texts is the number of letter n-grams of one to ``longest``
letters that both hold, over the root of the numbers each holds. Nyström landmarks
stand for the kernel's feature space; kernel ridge regression, one language
against the rest, is fitted on a bounded labelled sample. Texts are scored in
batches by matrix products: presence of n-grams, kernel to landmarks, scores.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows

UNKNOWN = "und"
CHUNK_CHARS, CHUNK_TEXTS = 1 << 19, 256


class Letters:
    """Codes of lower-cased letters; all else is one blank, texts are kept apart by zeros."""

    def __init__(self):
        self.known = np.zeros(0x110000, np.uint8)  # 1: no letter, 2: letter

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """Codes of all texts in a row, the text each belongs to, and whether it has letters."""
        parts, owner, lettered = [], [], []
        for i, text in enumerate(texts):
            codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
            new = np.unique(codes[self.known[codes] == 0])
            self.known[new] = [1 + chr(c).isalpha() for c in new.tolist()]
            letter = self.known[codes] == 2
            lettered.append(bool(letter.any()))
            codes = np.where(letter, codes, 32)
            keep = letter | np.r_[True, letter[:-1]] if len(codes) else letter  # one blank for a run
            codes = np.r_[np.uint32(32), codes[keep], np.uint32(32), np.uint32(0)]
            parts.append(codes.astype(np.uint64))
            owner.append(np.full(len(codes), i, np.int32))
        return np.concatenate(parts), np.concatenate(owner), lettered


def grams(codes: np.ndarray, longest: int):
    """(codes, place of each n-gram's start) for every length: 21 bits a letter, no hashing."""
    gram = codes
    for length in range(1, longest + 1):
        if length > 1:
            gram = (gram[: len(codes) - length + 1] << np.uint64(21)) | codes[length - 1 :]
        whole = codes[length - 1 :] != 0
        for back in range(1, length):
            whole &= codes[length - 1 - back : len(codes) - back] != 0
        yield gram[whole], np.flatnonzero(whole)


def _mix(x: np.ndarray) -> np.ndarray:
    return (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - Vocabulary.BITS)


class Vocabulary:
    """Rows of known n-grams, looked up by the leading bits of a product hash."""

    BITS = 16

    def __init__(self, known: np.ndarray):
        known = known[np.argsort(_mix(known), kind="stable")]
        slots = _mix(known).astype(np.int64)
        self.first = np.searchsorted(slots, np.arange(1 << self.BITS)).astype(np.int32)
        self.depth = int(np.bincount(slots, minlength=1).max()) if len(slots) else 0
        self.size = len(known)
        self.known = np.r_[known, np.zeros(self.depth + 1, np.uint64)]

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Row of each code, -1 for an unknown one."""
        at = self.first[_mix(codes)]
        found = np.full(len(codes), -1, np.int32)
        for step in range(self.depth):
            hit = self.known[at + step] == codes
            found[hit] = at[hit] + step
        return found


class Model:
    """Landmarks and weights; ``score`` gives one column per language."""

    def __init__(self, texts: list[str], languages: list[str], landmarks: int, longest: int, ridge: float):
        self.longest, self.languages = longest, sorted(set(languages))
        per_language = max(1, landmarks // len(self.languages))
        taken: dict[str, int] = {}
        chosen = []
        for text, language in zip(texts, languages):
            if taken.get(language, 0) < per_language and len(chosen) < max(landmarks, 1):
                taken[language] = taken.get(language, 0) + 1
                chosen.append(text)
        codes, _, _ = Letters().codes(chosen)
        self.vocabulary = Vocabulary(np.unique(np.concatenate([g for g, _ in grams(codes, longest)])))
        self.landmarks = np.ones((self.vocabulary.size, 0), np.float32)
        self.landmarks = np.concatenate([self.presence(part)[0] for part in _chunks(chosen)]).T.copy()
        self.weights = np.eye(len(chosen))
        own = self.kernel(self.landmarks.T)
        values, vectors = np.linalg.eigh((own + own.T) / 2)
        sound = values > values.max() * 1e-6
        nystroem = vectors[:, sound] / np.sqrt(values[sound])
        features = np.concatenate([self.kernel(self.presence(part)[0]) for part in _chunks(texts)]) @ nystroem
        target = np.where(np.array(languages)[:, None] == np.array(self.languages)[None], 1.0, -1.0)
        gram = features.T @ features + ridge * np.eye(features.shape[1])
        self.weights = nystroem @ np.linalg.solve(gram, features.T @ target)

    def presence(self, texts: list[str], letters: Letters | None = None) -> tuple[np.ndarray, list[bool]]:
        codes, owner, lettered = (letters or Letters()).codes(texts)
        out = np.zeros((len(texts), self.vocabulary.size), np.float32)
        for gram, place in grams(codes, self.longest):
            rows = self.vocabulary.rows(gram)
            known = rows >= 0
            out[owner[place[known]], rows[known]] = 1
        return out, lettered

    def kernel(self, presence: np.ndarray) -> np.ndarray:
        shared = presence @ self.landmarks
        size = np.sqrt(np.maximum(presence.sum(1), 1)[:, None] * np.maximum(self.landmarks.sum(0), 1)[None])
        return (shared / size).astype(np.float64)

    def score(self, texts: list[str], letters: Letters) -> tuple[np.ndarray, list[bool]]:
        presence, lettered = self.presence(texts, letters)
        return self.kernel(presence) @ self.weights, lettered


def _chunks(texts: list[str]):
    part, size = [], 0
    for text in texts:
        if part and (size + len(text) > CHUNK_CHARS or len(part) == CHUNK_TEXTS):
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def labelled_sample(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    label_column: str,
    learn: Column,
    per_label: int,
    most_rows: int,
    most_chars: int,
) -> list[tuple[str, str]]:
    """(text, label) of ``per_label`` rows at most of each label and ``most_rows`` in all, by a hash of id and text.

    Rows are ranked, not ids, so what reaches the driver is bounded however often
    an id or a row repeats; every task cuts its own to ``per_label`` of each label
    before the shuffle. Texts beyond ``most_chars`` come last, and one is taken
    whole where a label has no other. With many labels each gives fewer rows, one
    at least; beyond ``most_rows`` labels the most frequent ones are learnt.
    """
    rows = documents.where(learn).select(
        documents[id_column].alias("id"),
        documents[label_column].cast("string").alias("label"),
        documents[text_column].alias("text"),
    )
    usable = rows.where("label IS NOT NULL AND text IS NOT NULL AND id IS NOT NULL")
    labels = usable.groupBy("label").agg(F.count("*").alias("n"))
    number = labels.count()
    if number > most_rows:
        frequent = labels.orderBy(F.desc("n"), "label").limit(most_rows)
        usable = usable.join(frequent.select("label"), "label", "left_semi")
    share = max(1, min(per_label, most_rows // max(1, number)))
    long = F.length("text") > most_chars
    order = Window.partitionBy("label").orderBy(long, F.xxhash64("id"), "id", F.xxhash64("text"), "text")
    ranked = usable.withColumn("n", F.row_number().over(order)).where(F.col("n") <= share)
    chosen = ranked.where(~long | (F.col("n") == 1)).orderBy("label", "n")
    return [(row["text"], row["label"]) for row in chosen.select("text", "label").collect()]


def predict_language(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    label_column: str,
    learn: Column,
    per_label: int = 250,
    most_rows: int = 64_000,
    most_chars: int = 20_000,
    landmarks: int = 96,
    longest: int = 3,
    ridge: float = 1e-3,
) -> DataFrame:
    """Predicted language of every whole text.

    ``learn`` says which rows may be learnt from; of them at most ``per_label``
    rows per label with at most ``most_chars`` characters are, and ``most_rows`` in
    all, which bounds what reaches the driver (see ``labelled_sample``). Returns ``id_column``, ``lang_pred``
    and ``score`` (0 to 1). One row per input row; ``und`` with score 0 for a text
    that is null or has no letters, and for all where nothing can be learnt;
    repeated rows and null ids stay; an empty table gives an empty result; other
    columns are ignored. Predictions depend on the text alone.
    """
    if not 1 <= longest <= 3:
        raise ValueError("longest must be 1, 2 or 3")
    sample = labelled_sample(documents, id_column, text_column, label_column, learn, per_label, most_rows, most_chars)
    sample = [(text, label) for text, label in sample if any(c.isalpha() for c in text)]
    model = Model([t for t, _ in sample], [x for _, x in sample], landmarks, longest, ridge) if sample else None
    rows = documents.select(documents[id_column].alias("id"), documents[text_column].alias("text"))

    def scan(batch: dict):
        letters, known = Letters(), model
        predicted, score = [], []
        for texts in _chunks([t or "" for t in batch["text"]]):
            if known is None:
                predicted += [UNKNOWN] * len(texts)
                score += [0.0] * len(texts)
                continue
            scores, lettered = known.score(texts, letters)
            best = np.argmax(scores, axis=1)
            sure = np.clip((scores[np.arange(len(texts)), best] + 1) / 2, 0, 1)
            predicted += [known.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            score += [float(s) if ok else 0.0 for s, ok in zip(sure, lettered)]
        yield {"id": batch["id"], "lang_pred": predicted, "score": score}

    kind = rows.schema["id"].dataType.simpleString()
    return map_rows(rows, scan, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_column)
