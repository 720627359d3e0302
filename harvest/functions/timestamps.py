"""ISO time text to zone-free timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The accepted extended ISO format and its offset suffix.
ISO_FORMAT = r"^\d{4}-\d\d-\d\d([T ]\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:?\d\d)?)?$"
ISO_OFFSET = r"(Z|[+-]\d\d:?\d\d)$"
OFFSET_PARTS = r"([+-])(\d\d):?(\d\d)$"


def parse_ts(text: Column | str, mode: str = "wall") -> Column:
    """Parse ISO text to timestamp_ntz, NULL where the text is missing or not ISO.

    `wall` keeps the clock reading and drops the offset; `utc` moves the reading to UTC first. Text without an
    offset reads as UTC in both modes. The result does not depend on the session time zone.
    """
    if mode not in ("wall", "utc"):
        raise ValueError(f"mode must be 'wall' or 'utc', not {mode!r}")
    text = F.col(text) if isinstance(text, str) else text
    # The cast to a zone-free timestamp reads past a final Z by itself.
    bare = F.when(text.endswith("Z"), text).otherwise(F.regexp_replace(text, ISO_OFFSET, ""))
    wall = F.when(text.rlike(ISO_FORMAT), bare.try_cast("timestamp_ntz"))
    if mode == "wall":
        return wall

    def part(group: int) -> Column:
        return F.regexp_extract(text, OFFSET_PARTS, group)

    offset = F.make_dt_interval(F.lit(0), part(2).cast("int"), part(3).cast("int"))
    has_offset = text.rlike(r"[T ].*[+-]\d\d:?\d\d$")
    return F.when(~has_offset, wall).when(part(1) == "+", wall - offset).otherwise(wall + offset)


def bad_ts(text: Column, parsed: Column) -> Column:
    """True where time text is present but could not be parsed; missing and empty text are fine."""
    return (text != "") & parsed.isNull()
