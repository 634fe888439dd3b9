"""Plan guards: size-checked broadcast of materialised lookup tables and plan
inspection helpers used by tests and the benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.plans import workspace
from pickwise.session import shared_dir

# Largest lookup table (bytes) that is broadcast.  Hero-keyed tables hold at most
# H² rows for a vocabulary of H heroes (about 150² for the game).
MAX_BROADCAST_BYTES = 64 << 20
SALTS = 32  # copies of a larger lookup table; each key's rows spread over as many tasks


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint directory (survives
    executor loss; cuts lineage).  Used for small derived lookup tables that
    are read several times.  Inside an active workspace the table is written there
    and goes when the workspace closes."""
    if (owner := workspace.current()) is not None:
        return owner.table(df)
    shared_dir(df.sparkSession)  # makes sure a checkpoint directory is set
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder (or the active workspace), read back: for
    tables of all rows that are read several times, of which a checkpoint would be many
    times larger."""
    return (workspace.current() or workspace.Workspace(df.sparkSession, "table")).table(df)


def table_bytes(df: DataFrame) -> int:
    """Size of a materialised table of fixed-width columns: rows × row width."""
    return df.count() * (8 + 8 * len(df.columns))


class Lookup:
    """A materialised lookup table with its measured size.

    :meth:`join` broadcasts it while it is within ``max_bytes``.  Beyond that the
    table is copied ``SALTS`` times and every probing row draws one copy by a hash
    of its content, so that the rows of one key are spread over ``SALTS`` tasks.
    """

    def __init__(self, df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES):
        self.table = materialize(df)
        self.small = table_bytes(self.table) <= max_bytes

    def join(self, rows: DataFrame, on: list[str], how: str = "inner", where: Column | None = None, columns: list | None = None) -> DataFrame:
        side = self.table if where is None else self.table.where(where)
        side = side if columns is None else side.select(*columns)
        if self.small:
            return rows.join(F.broadcast(side), on, how)
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*[c for c, t in rows.dtypes if not t.startswith("map")]), F.lit(SALTS)))
        copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as text, captured from ``df.explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of a physical operator name in the executed plan."""
    return plan_text(df, "simple").count(name)
