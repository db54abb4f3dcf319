"""Document fingerprints as invertible Bloom lookup sketches, with DataFrame functions only.

A text's paragraphs (here: sentences and lines) are hashed into cells, each with a count, the
combined digests and the combined checks of what fell into it. The sketches of two versions are
subtracted cell by cell; cells with one digest left give it away, and taking it out of its other
cells frees more, until nothing is left. Sketches too small for the difference are made again,
four times larger.
"""

from __future__ import annotations

from collections import Counter
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.staging import Scratch, picked

#: Where paragraphs end: at new lines, behind sentence marks and white space, and behind the
#: sentence marks of scripts that need none.
BOUNDARY = r"\n|(?<=[.!?])\s+|(?<=[。！？।؟۔።])"
#: Paragraphs of more code points are cut further: behind words, and in words of more than
#: ``LONG_WORD`` code points behind characters, whose hash is a multiple of ``CUT_ONE_IN``.
LONG_PARAGRAPH, LONG_WORD, CUT_ONE_IN = 400, 64, 16
#: Cells in each of the three parts of the smallest sketch, which is the fingerprint.
PART_CELLS = 8
PASSES = 4
GROWTH = 4
#: Documents in a run of neighbouring ids. The runs' bounds travel with the plan; there are
#: ``MAX_RUNS`` of them at most, so runs of more than ten million documents are longer. A run is
#: sorted by one task, which spills, and holds no more than two rows at a time beside that.
RUN_DOCS, MAX_RUNS = 100, 100_000


def _marked(parts: Column) -> Column:
    """A line end behind the parts that end a piece; what is cut depends on content alone."""
    return F.transform(parts, lambda p: F.when(
        F.pmod(F.xxhash64(p), F.lit(CUT_ONE_IN)) == 0, F.concat(p, F.lit("\n"))).otherwise(p))


def _pieces(paragraph: Column) -> Column:
    """A long paragraph's pieces, which are the same wherever the same words stand."""
    words = F.transform(F.split(paragraph, r"\s+", -1), lambda w: F.when(
        F.char_length(w) > LONG_WORD, F.array_join(_marked(F.split(w, "")), "")).otherwise(w))
    return F.split(F.array_join(_marked(words), " "), "\n", -1)


def paragraph_digests(text: Column) -> Column:
    """The distinct 32-bit digests of a text's paragraphs."""
    parts = F.flatten(F.transform(F.split(text, BOUNDARY, -1), lambda p: F.when(
        F.char_length(p) > LONG_PARAGRAPH, _pieces(p)).otherwise(F.array(p))))
    parts = F.filter(parts, lambda p: F.btrim(p) != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p).bitwiseAND(
        F.lit(0xFFFFFFFF))))


def _check(digest: Column) -> Column:
    return F.xxhash64(F.lit(99), digest).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(part: int, digest: Column, part_cells: int) -> Column:
    return F.lit(part * part_cells) + F.pmod(
        F.xxhash64(F.lit(part_cells), F.lit(part), digest), F.lit(part_cells))


def _entries(digest: Column, count: Column, part_cells: int) -> list[Column]:
    """What a digest puts into its cell of each part."""
    return [F.struct(_cell(j, digest, part_cells).alias("cell"), count.alias("n"),
                     digest.alias("digest"), _check(digest).alias("check")) for j in range(3)]


def sketch(units: DataFrame, by: list[str], part_cells: int) -> DataFrame:
    """Cells of the sketches of ``units(*by, digest, sign)``; cells without content are left out.

    Digests of different sign cancel, which subtracts sketches while they are made.
    """
    filled = units.select(*by, F.explode(F.array(*_entries(F.col("digest"), F.col("sign"),
                                                           part_cells))).alias("e"))
    return _folded(filled, by)


def _folded(entries: DataFrame, by: list[str]) -> DataFrame:
    return (entries.groupBy(*by, F.col("e.cell").alias("cell"))
            .agg(F.sum("e.n").alias("n"), F.bit_xor("e.digest").alias("digest"),
                 F.bit_xor("e.check").alias("check"))
            .filter("n <> 0 OR digest <> 0 OR check <> 0"))


def peel(cells: DataFrame, by: list[str], part_cells: int) -> DataFrame:
    """Per sketch how many digests were recovered and how many cells could not be emptied.

    Parts take turns, as a digest has one cell in each: so none is taken out twice at a time.
    Recovered digests are counted in a cell of their own, number -1.
    """
    one = F.lit(1).cast("bigint")
    for turn in range(3 * PASSES):
        part = turn % 3
        pure = ((F.abs("n") == 1) & (F.col("check") == _check(F.col("digest")))
                & (F.floor(F.col("cell") / part_cells) == part))
        own = F.struct(F.col("cell").cast("bigint").alias("cell"), "n", "digest", "check")
        counted = F.struct(F.lit(-1).cast("bigint").alias("cell"), one.alias("n"),
                           F.lit(0).cast("bigint").alias("digest"),
                           F.lit(0).cast("bigint").alias("check"))
        removed = _entries(F.col("digest"), -F.col("n"), part_cells)
        cells = _folded(cells.select(*by, F.explode(
            F.when(pure, F.array(own, counted, *removed)).otherwise(F.array(own))).alias("e")), by)
    return cells.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("cell") == -1, F.col("n"))), F.lit(0)).alias("recovered"),
        F.count(F.when(F.col("cell") >= 0, 1)).alias("stuck"))


def differences(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, kind, differing)`` for ``pairs(id, kind, a, b)`` of digest sets, ``id`` and ``kind``
    being unique together: how many digests are in one of ``a`` and ``b`` only."""
    done, part_cells, turn = None, PART_CELLS, 0
    by = ["id", "kind"]
    while True:
        units = pairs.repartition("id", "kind").select(*by, F.explode(F.concat(
            F.transform("a", lambda d: F.struct(d.alias("digest"), F.lit(1).cast("bigint")
                                                .alias("sign"))),
            F.transform("b", lambda d: F.struct(d.alias("digest"), F.lit(-1).cast("bigint")
                                                .alias("sign"))))).alias("u"))
        units = units.select(*by, "u.digest", "u.sign")
        found = scratch.write(peel(sketch(units, by, part_cells), by, part_cells), "peeled")
        good = found.filter("stuck = 0").select(*by, F.col("recovered").alias("differing"))
        done = good if done is None else done.unionByName(good)
        failed = found.filter("stuck > 0").select(*by)
        if failed.isEmpty():
            break
        pairs = scratch.write(pairs.join(failed, by, "left_semi"), f"again-{turn}")
        scratch.release(f"again-{turn - 1}")
        part_cells, turn = part_cells * GROWTH, turn + 1
    return done


def fingerprint_text(cells: DataFrame, by: list[str]) -> DataFrame:
    """The sketch of each group as one string, cell by cell."""
    wide = lambda c, n: F.lpad(F.hex(F.col(c)), n, "0")
    packed = F.struct("cell", F.concat(wide("cell", 2), wide("n", 8), wide("digest", 8),
                                       wide("check", 8)).alias("hex"))
    joined = F.array_join(F.array_sort(F.collect_list(packed))["hex"], "")
    lines = F.base64(F.unhex(joined))
    return cells.groupBy(*by).agg(F.translate(lines, "\r\n", "").alias("sketch"))


def read_fingerprint(text: Column) -> Column:
    """The cells of a fingerprint, as ``fingerprint_text`` packed them."""
    packed = F.hex(F.unbase64(text))
    size = (F.char_length(packed) / 26).cast("int")

    def number(i: Column, start: int, digits: int) -> Column:
        return F.conv(F.substring(packed, i * 26 + start, F.lit(digits)), 16, 10).cast("bigint")

    return F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        number(i, 1, 2).alias("cell"), number(i, 3, 8).alias("n"),
        number(i, 11, 8).alias("digest"), number(i, 19, 8).alias("check"))))


def compare_fingerprints(pairs: DataFrame) -> DataFrame:
    """How many paragraphs differ, from two fingerprints alone: ``(id, differing)``.

    ``pairs`` needs ``id`` (unique), ``a`` and ``b``, fingerprints as strings. ``differing`` is
    NULL where the sketches are too small to give all digests back; then only larger ones, made
    from the texts, can tell. This is the first step of ``differences``, from stored strings.
    """
    def signed(side: str, sign: int) -> Column:
        return F.transform(F.coalesce(read_fingerprint(F.col(side)), F.array()), lambda c: F.struct(
            c["cell"].alias("cell"), (c["n"] * sign).alias("n"), c["digest"].alias("digest"),
            c["check"].alias("check")))

    entries = F.explode(F.concat(signed("a", 1), signed("b", -1))).alias("e")
    cells = _folded(pairs.select("id", entries), ["id"])
    found = peel(cells, ["id"], PART_CELLS)
    return pairs.select("id").join(found, "id", "left").select("id", F.when(
        F.coalesce("stuck", F.lit(0)) == 0, F.coalesce("recovered", F.lit(0))).alias("differing"))


def likeness(n_a: Column, n_b: Column, differing: Column) -> Column:
    """Common paragraphs among all; 1 if neither text has any."""
    either = (n_a + n_b + differing) / 2
    return F.when(either == 0, F.lit(1.0)).otherwise((n_a + n_b - differing) / 2 / either)


def _run_number(order: Column, row: Column, quantiles: list[int]) -> Column:
    """The run of a row, growing with ``(order, row)``, by bisection of the quantiles.

    An id that is several quantiles has as many runs and one more, cut evenly by the hash ``row``.
    """
    often = Counter(quantiles)
    apart = {q - 1 for q, n in often.items() if n > 1 and q > -(1 << 63)}
    bounds = sorted(set(quantiles) | apart)
    slices = [often[b] + 1 if often[b] > 1 else 1 for b in bounds] + [1]
    firsts = [0, *accumulate(slices)][:-1]

    def listed(numbers: list[int]) -> Column:
        return F.from_json(F.lit(str(numbers)), "array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(low: Column, s: Column) -> Column:
        reach = low + s
        fits = F.coalesce(F.get(listed(bounds), reach - 1) < order, F.lit(False))
        return F.when(fits, reach).otherwise(low)
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)
    if max(slices) == 1:
        return below.cast("bigint")

    def place(run: Column) -> Column:
        n = F.get(listed(slices), run)
        part = F.floor((row.cast("double") / 2.0 ** 64 + 0.5) * n).cast("bigint")
        return F.get(listed(firsts), run) + F.least(part, n - 1)
    # A transform of one element, so that the bisection is written once.
    return F.transform(F.array(below), place)[0]


def with_next(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Each row's ``text`` and ``units`` with ``next_text`` and ``next_units`` of the row that
    follows in descending order of id, the first following the last.

    Rows are cut into runs of neighbouring ids, so texts are shuffled once; the first row of each
    run is put at the end of the run before it as well. Bounds and first rows, one for each run,
    are all that is sent around: twice ``MAX_RUNS`` at most. An id of very many rows, as a missing
    one, is spread over several runs by its texts; equal texts of one id stay in one.
    """
    rows = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("order"),
        F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))
    keys = scratch.write(rows.select("order", "row"), "keys")
    n = keys.count()
    runs = max(1, min(MAX_RUNS, n // RUN_DOCS))
    bounds = keys.agg(F.percentile_approx("order", F.lit([i / runs for i in range(1, runs)] or [.5]),
                                          max(10_000, 4 * runs))).first()[0] or []
    run = _run_number(F.col("order"), F.col("row"), bounds)
    heads = (keys.withColumn("run", run).groupBy("run")
             .agg(F.max(F.struct("order", "row")).alias("head")))
    above = Window.orderBy("run")
    every = above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = scratch.write(heads.select("run", "head", F.coalesce(
        F.lead("run").over(above), F.min("run").over(every)).alias("to")), "heads")
    is_head = F.struct("order", "row") == F.col("head")
    places = F.when(is_head, F.array(F.struct(F.col("run"), F.lit(0).alias("copy")),
                                     F.struct(F.col("to").alias("run"), F.lit(1).alias("copy")))) \
        .otherwise(F.array(F.struct(F.col("run"), F.lit(0).alias("copy"))))
    # Exploded, as the optimizer otherwise carries the expression over to the other side.
    dealt = (rows.withColumn("units", paragraph_digests(F.col("text")))
             .select("*", F.explode(F.array(run)).alias("run")).join(F.broadcast(heads), "run")
             .select("doc_id", "order", "row", "text", "units", F.explode(places).alias("p"))
             .select("doc_id", "order", "row", "text", "units", "p.run", "p.copy"))
    down = Window.partitionBy("run").orderBy("copy", F.desc("order"), F.desc("row"))
    return (dealt.withColumn("next", F.lead(F.struct("text", "units")).over(down))
            .filter("copy = 0").select("doc_id", "text", "units",
                                       F.col("next.text").alias("next_text"),
                                       F.col("next.units").alias("next_units")))


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, its edited form, and their likeness.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored. The edited text
    has its last third (rounded down) replaced by the first as many code points of the next
    document in descending order of id, of the first one after the last. NULL is an empty text;
    a NULL id comes last; rows of one id follow each other in the order of a hash of the text.
    Returns for every row ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. Likeness is the share of common paragraphs, which the differing
    ones that the subtracted sketches gave back decide: those of the fingerprints, and where
    they are too small, larger ones of the same paragraphs. Whatever ``compare_fingerprints``
    reads out of two returned fingerprints is the same number. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    joined = with_next(picked(docs, "doc_id", "text"), scratch)
    n = F.char_length("text")
    tail = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - tail),
                      F.substring("next_text", F.lit(1), tail))
    rows = joined.select(
        "doc_id", n.cast("bigint").alias("n_chars"), "units", "next_units", edited.alias("edited"))
    rows = scratch.write(rows.select(
        F.monotonically_increasing_id().alias("id"), "doc_id", "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"), "units", "next_units",
        paragraph_digests(F.col("edited")).alias("edited_units")), "rows")

    versions = rows.repartition("id").select("id", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), "units"),
        F.struct(F.lit(1).alias("kind"), F.col("edited_units").alias("units")))).alias("v"))
    units = versions.select("id", F.col("v.kind").alias("kind"),
                            F.explode("v.units").alias("digest"),
                            F.lit(1).cast("bigint").alias("sign"))
    prints = fingerprint_text(sketch(units, ["id", "kind"], PART_CELLS), ["id", "kind"])
    prints = scratch.write(prints.groupBy("id").agg(
        F.max(F.when(F.col("kind") == 0, F.col("sketch"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("sketch"))).alias("edited_fingerprint")), "prints")

    pairs = rows.select("id", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("edited_units").alias("b")),
        F.struct(F.lit(1).alias("kind"), F.col("next_units").alias("b")))).alias("v"),
        F.col("units").alias("a")).select("id", "v.kind", "a", "v.b")
    apart = (differences(pairs, scratch).groupBy("id").agg(
        F.max(F.when(F.col("kind") == 0, F.col("differing"))).alias("from_edited"),
        F.max(F.when(F.col("kind") == 1, F.col("differing"))).alias("from_next")))
    sizes = rows.select("id", "doc_id", "n_chars", "edited_sha256", F.size("units").alias("n"),
                        F.size("edited_units").alias("n_edited"),
                        F.size("next_units").alias("n_next"))
    none = F.lit(0).cast("bigint")
    return (sizes.join(prints, "id", "left").join(apart, "id", "left").select(
        "doc_id", "n_chars", "edited_sha256",
        F.coalesce("fingerprint", F.lit("")).alias("fingerprint"),
        F.coalesce("edited_fingerprint", F.lit("")).alias("edited_fingerprint"),
        likeness(F.col("n"), F.col("n_edited"), F.coalesce("from_edited", none))
        .alias("near_edited"),
        likeness(F.col("n"), F.col("n_next"), F.coalesce("from_next", none)).alias("near_next")))
