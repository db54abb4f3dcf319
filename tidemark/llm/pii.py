"""Personal data: fixed patterns first, then what stands where they stand.

Seed entities are the spans of the fixed patterns, credentials of public formats, and, with less
weight, opaque tokens. The words around them are lexical patterns; patterns and the identifier-like
tokens that they surround make a graph on which Spark scores both sides in turn. What no pattern is
judged by yet is left out; ordinary words in the same place, and numbers that look like a kind but
fail its test, count against a pattern. Tokens that patterns of high confidence surround are new
spans, and so are the credentials.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.staging import Scratch, picked

# The kinds in order, and their patterns. Runs are matched possessively and from
# their first character only, which finds the same spans without trying each start in a run.
KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: What may be an identifier: what stands with a digit between blanks, quotes, brackets and marks.
CUT = r"\s\"'()\[\]{}<>,;!?=:"
CANDIDATE = re.compile(rf"(?<![^{CUT}])[^{CUT}0-9]*+[0-9][^{CUT}]*+")
LEAST_LENGTH = 6

# Credentials whose makers publish their format, and what looks drawn at random.
CREDENTIAL = re.compile(r"A(?:KIA|SIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}")
OPAQUE = re.compile(r"(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{16,64}")
LIKELY = 0.95

#: Words as patterns see them: no quotes or brackets, a name with the sign that assigns to it, and
#: the ends of lines. A mention is one mark.
WORD = re.compile(rf"\0|[^\0{CUT}]+(?:[^\S\n]*[=:]+)?|\n")
MARK = "\0"
LINE_END = "^"
KNOWN_WORDS = 100_000

#: Bits that say which patterns may be wanted; their number doesn't depend on that of patterns.
FILTER_BITS = 1 << 23


def emails(text: str) -> list[tuple[int, int]]:
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                found.append((start, domain.end()))
                free = domain.end()
        at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) <= 255)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all spans that the fixed patterns give, in order."""
    if not text:
        return []
    spans = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(map(_small, m.groups())):
                spans.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
        at = text.find("+")
        while at >= 0:
            m = PHONE.match(text, at)
            if m and 9 <= len(DIGIT.findall(m.group())) <= 15:
                spans.append((m.start(), 3, m.end()))
            at = text.find("+", m.end() if m else at + 1)
    return sorted(spans)


def _label(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _words(text: str, spans: list[tuple]) -> list[str]:
    """The words of a text, a mark for each of the ``spans``, which are in order and disjoint."""
    parts, at = ["\n"], 0
    for start, end, *_ in spans:
        parts += [text[at:start].replace(MARK, " "), f" {MARK} "]
        at = end
    parts.append(text[at:].replace(MARK, " "))
    return WORD.findall("".join(parts).lower())


def _plain(word: str) -> str:
    if word == "\n":
        return LINE_END
    if word == MARK:
        return "#"
    if word[-1] in "=:":
        return word.rstrip("=: \t\r\f\v").strip(".") + " ="
    return word.strip(".") or word


def _patterns(words: list[str], i: int) -> list[str]:
    """Lexical patterns around word ``i``: a word or two before it, a word after it, a word on
    either side. The ends of a line are words, and a name that is assigned to has its sign."""
    before, found = _plain(words[i - 1]), []
    after = _plain(words[i + 1]) if i + 1 < len(words) else LINE_END
    found = [f"{before} _", f"{before} _ {after}", f"_ {after}"]
    if i > 1:
        found.append(f"{_plain(words[i - 2])} {before} _")
    return found


def refuted(token: str) -> bool:
    """Whether a token has the form of a card or an address and fails its test."""
    ip = IP.fullmatch(token)
    if ip:
        return not all(map(_small, ip.groups()))
    digits = token.replace("-", "")
    return digits.isascii() and digits.isdigit() and 12 <= len(digits) <= 19 and not luhn(digits)


def pattern_filter(patterns: DataFrame) -> bytes:
    """Bits at which the CRC of each of ``patterns(pattern)`` falls. At most ``FILTER_BITS`` / 64
    numbers reach the driver, however many patterns there are; what a full filter lets through
    is told apart by the join behind it."""
    at = F.crc32(F.col("pattern").cast("binary")).bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = (patterns.select(at.alias("at"))
            .groupBy(F.expr("at div 64").alias("place"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits")).collect())
    bits = np.zeros(FILTER_BITS // 64, "<i8")
    bits[[r["place"] for r in rows]] = [r["bits"] for r in rows]
    return bits.tobytes()


def count_ordinary(words: list[str], wanted: bytes, known: dict[str, tuple],
                   counts: Counter[str]) -> None:
    """Adds to ``counts`` how often ordinary words stand in patterns that may be wanted.

    ``known`` remembers of each word its plain form and whether it may be wanted before or after a
    place. A pattern that begins with a word is wanted only if the word by itself is.
    """
    def may(pattern: str) -> bool:
        at = zlib.crc32(pattern.encode("utf-8", "replace")) & (FILTER_BITS - 1)
        return bool(wanted[at >> 3] >> (at & 7) & 1)

    def learn(word: str) -> tuple:
        plain = _plain(word)
        known[word] = told = (plain, may(f"{plain} _"), may(f"_ {plain}"),
                              word != MARK and word != "\n")
        return told

    if len(known) > KNOWN_WORDS:
        known.clear()
    told = [known.get(w) or learn(w) for w in words]
    last = len(told) - 1
    for i, (plain, leads, trails, _) in enumerate(told):
        if trails and i and told[i - 1][3]:
            counts[f"_ {plain}"] += 1
        if leads and i < last and told[i + 1][3]:
            counts[f"{plain} _"] += 1
            after = told[i + 2][0] if i + 1 < last else LINE_END
            both = [f"{plain} _ {after}"]
            if i:
                both.append(f"{told[i - 1][0]} {plain} _")
            for pattern in both:
                if may(pattern):
                    counts[pattern] += 1
    if told and told[-1][3] and may(f"_ {LINE_END}"):
        counts[f"_ {LINE_END}"] += 1


def _ordinary(wanted: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0):
                text = text.as_py() or ""
                count_ordinary(_words(text, mentions(text, base_spans(text))), wanted, known,
                               counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["pattern", "ordinary"])
    return run


def prior(token: str) -> float | None:
    """What is known of a token that no fixed pattern found, before any context is judged."""
    return 1.0 if CREDENTIAL.fullmatch(token) else LIKELY if OPAQUE.fullmatch(token) else None


def mentions(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """Base spans, those that overlap joined, and identifier-like tokens that touch none of them,
    in order: ``(start, end, base)``."""
    out = [(s, e, True) for s, e in _joined(spans)]
    ends = [e for _, e, _ in out]
    at = 0
    for m in CANDIDATE.finditer(text) if DIGIT.search(text) else ():
        start, end = m.span()
        while start < end and text[start] == ".":
            start += 1
        while start < end and text[end - 1] == ".":
            end -= 1
        while at < len(ends) and ends[at] <= start:
            at += 1
        clear = at == len(ends) or out[at][0] >= end
        if clear and end - start >= LEAST_LENGTH and DIGIT.search(text, start, end):
            out.append((start, end, False))
    return sorted(out)


def _joined(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, _, e in spans:
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


SCANNED = ("doc_id bigint, row bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
           "base_sha256 string, spans string, mentions array<struct<start:bigint,stop:bigint,"
           "base:boolean,prior:double,refuted:boolean,instance:binary,patterns:array<string>>>")
_MENTION = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()),
                      ("prior", pa.float64()), ("refuted", pa.bool_()), ("instance", pa.binary()),
                      ("patterns", pa.list_(pa.string()))])


def _mentions(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    said = mentions(text, spans)
    if not said:
        return []
    words = _words(text, said)
    places = (i for i, w in enumerate(words) if w == MARK)
    return [{"start": s, "stop": e, "base": base,
             "prior": 1.0 if base else prior(text[s:e]),
             "refuted": not base and refuted(text[s:e]),
             "instance": hashlib.md5(text[s:e].lower().encode()).digest(),
             "patterns": _patterns(words, i)} for (s, e, base), i in zip(said, places)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, hashes, labels, found = [[] for _ in KINDS], [], [], []
        for text in batch.column(2):
            text = text.as_py() or ""
            spans = base_spans(text)
            for k, column in enumerate(counts):
                column.append(sum(1 for s in spans if s[1] == k))
            labels.append(_label(spans))
            hashes.append(hashlib.sha256(labels[-1].encode()).hexdigest())
            found.append(_mentions(text, spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1),
             *[pa.array(c, pa.int64()) for c in counts], pa.array(hashes, pa.string()),
             pa.array(labels, pa.string()), pa.array(found, pa.list_(_MENTION))],
            names=["doc_id", "row", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "mentions"])


def score_graph(edges: DataFrame, ordinary: DataFrame, scratch: Scratch, rounds: int, least: float,
                support: int) -> DataFrame:
    """Instances that are not sure seeds and are reached by patterns of high confidence.

    ``edges(pattern, instance, prior, refuted)`` are distinct, ``prior`` being 1 for sure seeds, less
    for likely ones, else NULL; ``ordinary(pattern, ordinary)`` counts ordinary words. A pattern's
    confidence is the mean over what is known of its places, if it has ``support`` scored
    instances: seeds have their prior, found instances their own score, refuted ones and ordinary
    words 0. Instances that nothing is known of take no part. An instance's score is the chance
    that not all of its confident patterns err. Both sides are folded by key, so a pattern seen
    everywhere costs one row per task.
    """
    seeds = scratch.write(edges.filter("prior IS NOT NULL")
                          .select("instance", F.col("prior").alias("score")).distinct(), "seeds")
    scores, new = seeds, None
    for turn in range(rounds):
        confident = (edges.join(scores, "instance", "left").groupBy("pattern")
                     .agg(F.sum("score").alias("good"), F.count("score").alias("scored"),
                          F.count_if("refuted").alias("bad"))
                     .filter(F.col("scored") >= support).join(ordinary, "pattern", "left")
                     .withColumn("confidence", F.col("good") / (
                         F.col("scored") + F.col("bad") + F.coalesce("ordinary", F.lit(0))))
                     .filter(F.col("confidence") >= least).select("pattern", "confidence"))
        confident = scratch.write(confident, f"patterns-{turn}")
        doubt = F.sum(F.log(F.lit(1.0001) - F.col("confidence")))
        new = (edges.filter("coalesce(prior, 0) < 1 AND NOT refuted").join(confident, "pattern")
               .groupBy("instance").agg((1 - F.exp(doubt)).alias("score"))
               .filter(F.col("score") >= least))
        new = scratch.write(new, f"found-{turn}")
        scores = seeds.unionByName(new.join(seeds, "instance", "left_anti"))
    return new


def find_personal_data(docs: DataFrame, rounds: int = 3, least: float = 0.9,
                       support: int = 5) -> DataFrame:
    """Spans of personal data in ``docs(doc_id, text)``; other columns are ignored.

    Returns for every row ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found``.
    ``spans`` lists all spans as ``kind:start:end`` in code points, those of the fixed patterns
    and, as kind ``id``, credentials of public formats and what contexts revealed; ``base_sha256`` is
    the hash of the former. An opaque token (16 to 64 lower-case hexadecimal digits, letters among
    them) is a seed of less weight and listed only if a context reveals it.
    A NULL text is an empty one. Rows of one id are searched each by itself. No rows give no rows.

    Documents are read once for spans and once to count ordinary words in the patterns that
    ``support`` identifiers share. Those patterns go to the tasks as a filter of fixed size; what
    is joined are spans, patterns and hashes of tokens.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "pii")
    rows = picked(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"), "text")
    scanned = scratch.write(rows.mapInArrow(_scan, SCANNED), "scanned")
    said = scanned.select("doc_id", "row", F.explode("mentions").alias("m")).select(
        "doc_id", "row", "m.start", "m.stop", "m.base", "m.prior", "m.refuted", "m.instance",
        "m.patterns")
    edges = (said.select(F.explode("patterns").alias("pattern"), "instance", "prior", "refuted")
             .groupBy("pattern", "instance")
             .agg(F.max("prior").alias("prior"), F.min("refuted").alias("refuted")))
    edges = scratch.write(edges, "edges")
    shared = (edges.filter("NOT refuted").groupBy("pattern")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.count_if(F.coalesce("prior", F.lit(0)) < 1).alias("unsure"))
              .filter((F.col("n") >= support) & (F.col("unsure") > 0)).select("pattern"))
    shared = scratch.write(shared, "shared")
    ordinary = (picked(docs, "text")
                .mapInArrow(_ordinary(pattern_filter(shared)), "pattern string, ordinary bigint")
                .groupBy("pattern").agg(F.sum("ordinary").alias("ordinary"))
                .join(shared, "pattern", "left_semi"))
    ordinary = scratch.write(ordinary, "ordinary")
    new = score_graph(edges, ordinary, scratch, rounds, least, support).select("instance")
    loose = said.filter("NOT base")
    spans = (loose.filter("prior = 1").unionByName(loose.join(new, "instance", "left_semi"))
             .select("doc_id", "row", "start", "stop").distinct()
             .groupBy("doc_id", "row").agg(F.collect_list(F.struct("start", "stop")).alias("more")))
    spans = scratch.write(spans, "found")
    known = scanned.drop("mentions")
    named = (known.join(spans.withColumnRenamed("doc_id", "id_"), (known["row"] == spans["row"])
                        & known["doc_id"].eqNullSafe(F.col("id_")), "left")
             .select(*[known[c] for c in known.columns if c != "row"], "more"))
    base = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.struct(
        F.split_part(s, F.lit(":"), F.lit(2)).cast("bigint").alias("start"),
        F.array_position(F.array(*map(F.lit, KINDS)), F.split_part(s, F.lit(":"), F.lit(1)))
        .alias("kind"), s.alias("label")))
    extra = F.transform(F.coalesce("more", F.array()), lambda m: F.struct(
        m["start"].alias("start"), F.lit(len(KINDS) + 1).cast("bigint").alias("kind"),
        F.concat_ws(":", F.lit(FOUND), m["start"], m["stop"]).alias("label")))
    merged = F.concat_ws(",", F.array_sort(F.concat(base, extra))["label"])
    return named.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
                        F.when(F.col("more").isNull(), F.col("spans")).otherwise(merged)
                        .alias("spans"),
                        F.coalesce(F.size(F.coalesce("more", F.array())), F.lit(0)).cast("bigint")
                        .alias("n_found"))
