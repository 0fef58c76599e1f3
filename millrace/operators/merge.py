"""The column-wise upsert, and the keyed delete-then-append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.lastwriter import writes
from millrace.session import broadcast_limit, estimated_bytes

# Wide tables make many column expressions.  They are given as SQL text, which
# reaches the JVM in one call per column.

_NEW = "_new_"
_WRITES = "_writes_"


def same_key(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality over two lists of key columns; a null key equals nothing."""
    return F.expr(" and ".join(f"`{a}` = `{b}`" for a, b in zip(left, right, strict=True)))


def aligned(incoming: DataFrame, schema: T.StructType) -> DataFrame:
    """``incoming`` with a table's columns, types and column order.

    A column the batch does not bring is null; one the table lacks is an error.
    """
    unknown = [c for c in incoming.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    given = {f.name: f.dataType for f in incoming.schema.fields}

    def column(name: str, kind: T.DataType) -> str:
        if given.get(name) == kind:
            return f"`{name}`"
        value = f"`{name}`" if name in given else "null"
        return f"cast({value} as {kind.simpleString()}) as `{name}`"

    return incoming.selectExpr(*[column(f.name, f.dataType) for f in schema.fields])


def merge(
    base: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    first_wins: Sequence[str] = (),
    null_policy: str = "keep_old",
    strategy: str = "auto",
    newest_by: str | None = None,
    touched_by: str | None = None,
    ranks: str | None = None,
) -> DataFrame:
    """Upsert ``incoming`` into ``base``.

    New keys are added, known keys patched column by column, other rows kept.
    Both sides must be unique on ``keys`` (see ``dedup_by_key``), so no key is
    heavier than any other in the joins below.  Rows with a null key match
    nothing and are carried through; split them off first.

    ``first_wins`` columns keep the stored value once there is one.  With
    ``null_policy="keep_old"`` a null in the batch never overwrites a value;
    with ``"overwrite"`` it does.

    ``newest_by`` names a column that ranks rows, such as the date of their
    batch.  Where the stored row ranks higher, the incoming one is late: it
    fills gaps and overwrites nothing (with ``"overwrite"`` it does nothing at
    all).  The higher rank is kept.  ``touched_by`` names a column that says
    what changed a row last; a late row that fills no gap leaves it alone.

    ``ranks`` names a struct with the rank of the last writer of each column it
    has a field for (see ``lastwriter``).  For these columns the higher rank
    wins, whatever the order in which batches come; a null never does.

    ``strategy="patch"`` streams the base past the batch without shuffling it,
    given that the batch is small enough for Spark to broadcast.
    ``"full_outer"`` is a single shuffled join for batches beyond that.
    ``"auto"`` is ``pick_strategy``.
    """
    if null_policy not in ("keep_old", "overwrite"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    incoming = aligned(incoming, base.schema)
    if strategy == "auto":
        strategy = pick_strategy(incoming)

    renamed = incoming.selectExpr(
        *[f"`{c}` as `{_NEW}{c}`" for c in incoming.columns], f"true as `{_NEW}`"
    )
    on = same_key(keys, [_NEW + k for k in keys])

    late = f"coalesce(`{newest_by}` > `{_NEW}{newest_by}`, false)" if newest_by else "false"
    by_rank = base.schema[ranks].dataType.names if ranks else []
    fixed = {*keys, *first_wins, newest_by, touched_by, ranks}
    gaps = [f"(`{c}` is null and `{_NEW}{c}` is not null)" for c in base.columns if c not in fixed]
    if ranks:
        gaps = [f"`{_WRITES}{c}`" for c in by_rank]
    fills = f"({' or '.join(gaps)})" if gaps and null_policy == "keep_old" else "false"

    def resolve(name: str) -> str:
        old, new = f"`{name}`", f"`{_NEW}{name}`"
        if name in by_rank:
            return f"if(`{_WRITES}{name}`, {new}, {old}) as {old}"
        if name == ranks:
            fields = [f"'{c}', if(`{_WRITES}{c}`, {new}.`{c}`, {old}.`{c}`)" for c in by_rank]
            return f"named_struct({', '.join(fields)}) as {old}"
        if newest_by and name == newest_by:
            return f"greatest({old}, {new}) as {old}"
        if newest_by and name == touched_by:
            return f"if({late} and not {fills}, {old}, coalesce({new}, {old})) as {old}"
        if name in first_wins:
            return f"coalesce({old}, {new}) as {old}"
        if null_policy == "overwrite" and name not in keys:
            return f"if(`{_NEW}` and not {late}, {new}, {old}) as {old}"
        if newest_by and name not in keys:
            return f"if({late}, coalesce({old}, {new}), coalesce({new}, {old})) as {old}"
        return f"coalesce({new}, {old}) as {old}"

    if strategy not in ("patch", "full_outer"):
        raise ValueError(f"unknown strategy {strategy!r}")
    met = base.join(renamed, on, "full_outer" if strategy == "full_outer" else "left_outer")
    if ranks:
        met = met.selectExpr("*", *[f"{writes(c, ranks, _NEW)} as `{_WRITES}{c}`" for c in by_rank])
    patched = met.selectExpr(*[resolve(c) for c in base.columns])
    if strategy == "full_outer":
        return patched
    return patched.unionByName(without_keys_of(incoming, matched_keys(base, incoming, keys), keys))


def pick_strategy(incoming: DataFrame) -> str:
    """By the optimizer's size of the batch, against the session's broadcast limit."""
    small = estimated_bytes(incoming) <= broadcast_limit(incoming.sparkSession)
    return "patch" if small else "full_outer"


def matched_keys(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the base that the batch brings again: no larger than the batch."""
    return base.select(*keys).join(incoming.select(*keys), list(keys), "left_semi")


def without_keys_of(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; null keys are kept."""
    return df.join(other.select(*keys), list(keys), "left_anti").select(*df.columns)


def delete_then_append(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace whole rows: drop the stored rows of the batch's keys, add the batch."""
    incoming = aligned(incoming, base.schema)
    return without_keys_of(base, incoming, keys).unionByName(incoming)
