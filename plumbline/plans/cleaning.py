"""Ordered cleaning of a location key.

The order of the steps differs by source and year and changes the result, so
each job names its steps as a string of letters:

U upper, S strip, L left strip, T right strip, R spelling map, M inline map,
X exclusion list, N drop null keys, F blank to UNDEFINED, V not vacant,
C append " County", Q drop listed zips, J zip to city.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import clean
from plumbline.operators.aggregates import Spec, pre_aggregate
from plumbline.operators.joins import enrich
from plumbline.operators.lookups import Lookup, lookup_of


@dataclass(frozen=True)
class Refs:
    """Dimensions every job shares.

    spine: city, county, ord; zips: zip, city; replacements: wrong, right;
    exclusions: one column.
    """

    spine: DataFrame
    zips: DataFrame
    replacements: DataFrame
    exclusions: DataFrame
    # Lookups made so far, with the frame each was made of.
    _lookups: dict[str, tuple[DataFrame, Lookup]] = field(default_factory=dict, repr=False, compare=False)

    def lookup(self, name: str) -> Lookup:
        """Lookup of ``replacements`` or ``exclusions``, fetched once for all jobs."""
        frame = getattr(self, name)
        if name not in self._lookups or self._lookups[name][0] is not frame:
            self._lookups[name] = (frame, lookup_of(frame if name == "replacements" else frame.select(frame.columns[0])))
        return self._lookups[name][1]

    def counties(self) -> DataFrame:
        return clean.distinct_values(self.spine, "county")


_PURE = {
    "U": text.upper_key,
    "S": text.strip,
    "L": text.lstrip,
    "T": text.rstrip,
    "F": text.undefined_if_blank,
    "C": lambda c: text.append_suffix(c, " County"),
}


def apply_steps(
    df: DataFrame,
    key: str,
    steps: str,
    refs: Refs,
    *,
    inline: dict[str, str] | None = None,
    drop_zips: tuple[str, ...] = (),
    texts: tuple[str, ...] = (),
    present: bool = False,
) -> DataFrame:
    """Run the steps on column ``key``.

    The spelling map also replaces in the text columns ``texts``: those that
    a job counts distinct values of. In the others it could change nothing
    that is used.

    ``present`` also drops rows that would end with a null key, as the
    group-by after the steps does: no step but J makes a null, and F leaves
    none, so they go before the other work is done on them.
    """
    def drop_absent(df: DataFrame) -> DataFrame:
        return df.filter(F.col(key).isNotNull()) if present and "F" not in steps else df

    if "J" not in steps:
        df = drop_absent(df)
    pending = expr = F.col(key)

    def flush(df: DataFrame) -> DataFrame:
        return df if expr is pending else df.withColumn(key, expr)

    for step in steps.split():
        if step in _PURE:
            expr = _PURE[step](expr)
            continue
        if step == "M":
            expr = text.replace_each(expr, inline or {})
            continue
        # the other steps need the key as a column; runs of the ones above
        # become one projection
        df, expr = flush(df), pending
        if step == "R":
            df = clean.replace_values(df, [key, *texts], refs.lookup("replacements"))
        elif step == "X":
            df = clean.exclude_values(df, key, refs.lookup("exclusions"))
        elif step == "N":
            df = clean.drop_null(df, [key])
        elif step == "V":
            df = clean.filter_ne(df, "vacant", "Y")
        elif step == "Q":
            df = clean.exclude_values(df, "zip", list(drop_zips))
        elif step == "J":
            df = drop_absent(enrich(df, refs.zips.select("zip", "city"), "zip", "zip"))
        else:
            raise ValueError(f"unknown cleaning step {step!r}")
    return flush(df)


def aggregate_cleaned(
    df: DataFrame, key: str, steps: str, refs: Refs, spec: Spec, *, texts: tuple[str, ...] = ()
) -> DataFrame:
    """``spec`` per cleaned key. Rows are summed per key as it is written first,
    so the steps see each spelling once (and each value of ``texts``, those
    that ``spec`` counts distinct values of). For steps that read no other
    column: all but V, Q and J."""
    if "F" not in steps.split():
        df = df.filter(F.col(key).isNotNull())
    spellings, finish = pre_aggregate(df, key, spec)
    return finish(apply_steps(spellings, key, steps, refs, texts=texts, present=True))


def steps_of(key: Column, steps: str, refs: Refs, *, vacant: str = "vacant") -> tuple[Column, Column] | None:
    """The steps as expressions: the cleaned key, and whether the row stays
    (with a key that is not null). None where a step takes a join: the zip
    lookup, or a map or list too large for a constant.

    Several orders of steps over one source are then columns of one scan.
    """
    spelling, excluded = refs.lookup("replacements"), refs.lookup("exclusions")
    if not (spelling.constant and excluded.constant):
        return None
    stays = F.lit(True)
    for step in steps.split():
        if step in _PURE:
            key = _PURE[step](key)
        elif step == "R":
            key = spelling.replace(key)
        elif step == "X":
            stays = stays & ~excluded.has(key)
        elif step == "N":
            stays = stays & key.isNotNull()
        elif step == "V":
            stays = stays & ~F.col(vacant).eqNullSafe(F.lit("Y"))
        else:
            return None
    return key, stays & key.isNotNull()
