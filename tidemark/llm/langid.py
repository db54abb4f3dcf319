"""Language identification in two levels.

A text's family is decided first, by linear support vector machines between families, then its
language, by machines between each two languages of that family. Features are hashed runs of
three bytes of the lower-cased text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.staging import picked

UNKNOWN = "und"
FEATURES = 4096
BLOCK = 1 << 20
#: Machines are fitted together between so many sides and so many others.
GROUP_SIDES = 6
# Which languages are closely related. A language not listed is its own family.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv", "celtic": "br cy ga gd", "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz", "semitic": "am ar he mt", "iranian": "fa ku ps tg",
    "indic": "bn gu hi mr ne pa sd si ur", "dravidian": "kn ml ta te",
}
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(lang: str) -> str:
    return _FAMILY_OF.get(lang, f"only {lang}")


class Machine(NamedTuple):
    """Separates ``first`` (positive side) from ``second``."""
    first: str
    second: str
    weights: np.ndarray
    bias: float
    slope: float


class Model(NamedTuple):
    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]


def _block_counts(block: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of the hashed trigrams that begin in each span; two zero bytes end every span."""
    raw = np.frombuffer(block, np.uint8).astype(np.uint32)
    code = raw[:-2] * np.uint32(0x9E3779B1) ^ raw[1:-1] * np.uint32(0x85EBCA77) \
        ^ raw[2:] * np.uint32(0xC2B2AE3D)
    code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(20)
    owner = np.repeat(np.arange(len(starts)), ends - starts)
    at = np.arange(len(owner)) + np.repeat(starts - np.concatenate(([0], np.cumsum(
        ends - starts)[:-1])), ends - starts)
    flat = np.bincount(owner * FEATURES + code[at], minlength=len(starts) * FEATURES)
    return flat.reshape(len(starts), FEATURES)


def features(texts: Sequence[str | None]) -> np.ndarray:
    """One unit vector per text, over the whole of it."""
    counts = np.zeros((len(texts), FEATURES), np.float32)
    waiting: list[tuple[int, bytes]] = []
    size = 0

    def flush():
        block = b"".join(d + b"\0\0" for _, d in waiting)
        lengths = np.array([len(d) for _, d in waiting])
        starts = np.concatenate(([0], np.cumsum(lengths + 2)[:-1]))
        np.add.at(counts, [i for i, _ in waiting], _block_counts(block, starts, starts + lengths))

    for i, text in enumerate(texts):
        data = (text or "").lower().encode()
        for at in range(0, len(data), BLOCK):
            part = data[at:at + BLOCK]
            if len(waiting) >= 256 or size + len(part) > BLOCK and waiting:
                flush()
                waiting, size = [], 0
            waiting.append((i, part))
            size += len(part)
    if waiting:
        flush()
    counts = np.sqrt(counts)
    return counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def fit_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3,
                rounds: int = 300) -> tuple[np.ndarray, float, float]:
    """A linear machine with squared hinge loss by accelerated descent, classes weighted alike;
    also the slope that turns its margins into chances."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    ahead, t, step = w.copy(), 1.0, 1.0 / (4.0 + penalty)
    for _ in range(rounds):
        short = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead + step * (2 * (x.T @ (weight * y * short)) - penalty * ahead)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    margin = y * (x @ w)
    slope = 3.0 / max(1e-3, float((weight * np.abs(margin)).sum()))
    return w[:-1].astype(np.float32), float(w[-1]), slope


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = part.column(2).to_pylist()
            keep = pa.array([has_letter(t) for t in texts], pa.bool_())
            vectors = pa.array([v.tobytes() for v in features(texts)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).filter(keep), part.column(1).filter(keep), vectors.filter(keep)],
                names=["lang", "place", "vector"])


def _fit_group(rows: pd.DataFrame) -> pd.DataFrame:
    """The machines between each two sides of a group that aren't of the same part of it."""
    out = []
    part_of = dict(zip(rows["side"], rows["part"]))
    for first, second in combinations(sorted(part_of), 2):
        if part_of[first] == part_of[second]:
            continue
        mine = rows[rows["side"].isin((first, second))]
        x = np.stack([np.frombuffer(v, np.float32) for v in mine["vector"]])
        w, bias, slope = fit_machine(x, np.where(mine["side"].to_numpy() == first, 1.0, -1.0))
        out.append((rows["level"].iloc[0], first, second, w.tobytes(), bias, slope))
    return pd.DataFrame(out, columns=["level", "first", "second", "weights", "bias", "slope"])


def _groups(sides: Sequence[str]) -> Iterator[list[tuple[str, int]]]:
    """Groups of sides with their part, so that each two sides meet once in different parts."""
    halves = [sides[i:i + GROUP_SIDES] for i in range(0, len(sides), GROUP_SIDES)]
    for i, one in enumerate(halves):
        if len(one) > 1:
            yield list(zip(one, range(len(one))))
        for other in halves[i + 1:]:
            yield [(side, 0) for side in one] + [(side, 1) for side in other]


def train(docs: DataFrame, per_language: int = 400) -> Model:
    """Fits on ``docs(doc_id, text, lang)``; rows without a language or a letter teach nothing.

    Every language that has such rows is learned. The sample is bounded: of each language the
    ``per_language`` documents first in the order of a hash of their id, each with its whole
    text. Only counts per language and the fitted weights reach the driver.
    """
    spark = docs.sparkSession
    labelled = picked(docs, "doc_id", "text", "lang").filter(
        "lang IS NOT NULL AND text IS NOT NULL").filter(F.col("text").rlike(r"\p{L}"))
    counts = (labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .collect())
    langs = sorted(r["lang"] for r in counts)
    families: dict[str, list[str]] = {}
    for lang in langs:
        families.setdefault(family(lang), []).append(lang)
    levels = [("family", sorted(families))]
    levels += [("language", members) for members in families.values()]
    uses = []
    for level, sides in levels:
        for number, group in enumerate(_groups(sides)):
            for side, part in group:
                members = families[side] if level == "family" else [side]
                uses += [(lang, level, f"{sides[0]} {number}", side, part,
                          max(1, per_language // len(members))) for lang in members]
    if not uses:
        return Model(families, [], {})
    # Rows far down the order are dropped before they are sorted; twice the share leaves enough.
    order = F.xxhash64(F.lit(11), F.col("doc_id"), F.col("text"))
    # The shares are as many as the languages and stand in the plan, so that the filter is applied
    # where the texts are read, and only what it leaves is shuffled by language.
    shares = F.from_json(F.lit(json.dumps({r["lang"]: min(1.0, (2.0 * per_language + 200) / r["n"])
                                           for r in counts})), "map<string,double>")
    likely = labelled.withColumn("turn", order).filter(
        F.pmod("turn", F.lit(1 << 20)) < shares[F.col("lang")] * (1 << 20))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("turn"))
    sample = (likely.withColumn("place", place).filter(F.col("place") <= per_language)
              .select("lang", F.col("place").cast("int").alias("place"), "text"))
    vectors = sample.mapInArrow(_featurise, "lang string, place int, vector binary")
    uses = spark.createDataFrame(uses, "lang string, level string, group string, side string, "
                                       "part int, upto int")
    fitted = (vectors.join(uses, "lang").filter("place <= upto").groupBy("level", "group")
              .applyInPandas(_fit_group, "level string, first string, second string, "
                                         "weights binary, bias double, slope double").collect())
    machines = [(r["level"], Machine(r["first"], r["second"],
                                     np.frombuffer(bytes(r["weights"]), np.float32), r["bias"],
                                     r["slope"])) for r in fitted]
    machines.sort(key=lambda m: m[1][:2])
    within: dict[str, list[Machine]] = {}
    for level, m in machines:
        if level == "language":
            within.setdefault(family(m.first), []).append(m)
    return Model(families, [m for level, m in machines if level == "family"], within)


def _vote(x: np.ndarray, classes: list[str], machines: list[Machine]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the class with most votes, by margins where level, and its least chance."""
    votes = np.zeros((len(x), len(classes)))
    chance = np.ones((len(x), len(classes)))
    at = {c: i for i, c in enumerate(classes)}
    for m in machines:
        margin = (x @ m.weights + m.bias) * m.slope
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        for c, q in ((m.first, p), (m.second, 1 - p)):
            votes[:, at[c]] += (q > 0.5) + 1e-3 * q
            chance[:, at[c]] = np.minimum(chance[:, at[c]], q)
    best = votes.argmax(axis=1)
    return best, chance[np.arange(len(x)), best]


def predict_texts(model: Model, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    rows = np.array([i for i, t in enumerate(texts) if has_letter(t)], int)
    if len(rows) == 0 or not model.families:
        return langs, scores.tolist()
    x = features([texts[i] for i in rows])
    names = sorted(model.families)
    chosen, p = _vote(x, names, model.between)
    for f, name in enumerate(names):
        mine = np.flatnonzero(chosen == f)
        if len(mine):
            members = model.families[name]
            best, q = _vote(x[mine], members, model.within.get(name, []))
            for i, b in zip(rows[mine], best):
                langs[i] = members[b]
            scores[rows[mine]] = p[mine] * q
    return langs, scores.tolist()


def predict(docs: DataFrame, model: Model, prefix: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``prefix`` of every row with ``lang_pred`` and ``score`` (0 to 1).

    Uses ``text`` only, the whole of it. A text that is NULL or has no letter is ``und`` with
    score 0; so is every text if nothing could be learned. No rows give no rows.
    """
    kept = picked(docs, *prefix)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                langs, scores = predict_texts(model, part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(langs, pa.string()),
                     pa.array(scores, pa.float64())],
                    names=[*part.schema.names[1:], "lang_pred", "score"])

    return (docs.select(docs["text"].alias("__text"), *[docs[f"`{c}`"] for c in prefix])
            .mapInArrow(run, f"{fields}, lang_pred string, score double"))


def is_held_out(doc_id: Column) -> Column:
    """The documents that nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, per_language: int = 400) -> DataFrame:
    """Trains on the documents that are not held out, and predicts for all of ``docs``.

    Returns ``doc_id, held_out, lang_pred, score``. A row without an id is not held out.
    """
    model = train(docs.filter(~is_held_out(F.col("doc_id"))), per_language)
    return predict(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                                       "lang_pred", "score")
