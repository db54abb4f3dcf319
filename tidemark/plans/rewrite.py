"""Changes to published tables that rewrite the files they touch, and no others.

The functions of ``operators.upsert`` give the next state of a table. Here the same functions are
asked twice: first for the files that hold rows they change, which reads keys, hashes and dates
alone, then for the next state of those files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.columns import quoted, require_values
from tidemark.sources.publish import (
    Live, file_of_row, live_step, publish, read_files, version_files, write_instead,
)

ACTION, FILE = "__action", "__file"


def rewrite_changed(spark: SparkSession, base: str, state_of: Callable[[DataFrame], DataFrame], *,
                    finish: Callable[[DataFrame], DataFrame] | None = None,
                    required: Sequence[str] = (), cluster_by: Sequence[str] = (),
                    view: str | None = None, catalog: bool = False, since: Live | None = None,
                    hold: bool = False) -> int:
    """Publishes the next state of a table, having written only files with changed rows anew.

    ``state_of`` is given rows of the table, of all files or of some, with one column more, ``FILE``,
    that it must carry along; it adds the column ``ACTION``, which is ``insert`` for a new row and
    ``same`` for one as it was. Whether a row changes must follow from the row itself and from what
    ``state_of`` brings along, which must be stored, as it is read three times. ``finish`` gets the
    inserted rows, for instance to number them.

    Rows that change nothing but lie in a file with others that do are written again with those; all
    other files stay and are named by the new version. So the work follows the number of files
    touched, and with ``cluster_by`` rows of neighbouring keys are kept in few of them. A reader
    sees one version or the other; another writer's step in between makes this one fail.

    ``since`` is where the log stood when work began, and the version to go on from, by default what
    is live. With ``hold`` the version is written but left to be published.
    """
    since = since or live_step(spark, base)
    if since.version is None:
        raise ValueError(f"nothing is published in {base}")
    files = version_files(spark, base, since.version)

    def rows(names: Sequence[str]) -> DataFrame:
        return read_files(spark, base, names).select("*", file_of_row().alias(FILE))

    table = rows(files)
    columns = [c for c in table.columns if c != FILE]
    state = state_of(table)
    touched = [r[0] for r in state.filter(~F.col(ACTION).isin("insert", "same"))
               .select(FILE).distinct().collect()]
    inserted = state.filter(F.col(ACTION) == "insert").select(*map(quoted, columns))
    if finish:
        inserted = finish(inserted).select(*map(quoted, columns))
    changed = inserted
    if touched:
        kept = state_of(rows(touched)).filter(F.col(ACTION) != "insert")
        changed = kept.select(*map(quoted, columns)).unionByName(inserted)
    if required:
        changed = require_values(changed, required)
    version = write_instead(changed, base, touched, since, cluster_by)
    if not hold:
        publish(spark, base, version, view, catalog)
    return version
