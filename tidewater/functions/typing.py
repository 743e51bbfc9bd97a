"""Raw text to typed columns, driven by one configuration an entity."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The source system's timestamp patterns.
EVENT_PATTERN, MASTER_PATTERN = "yyyy/MM/dd HH:mm:ss.SSS", "yyyy/MM/dd HH:mm:ss.SSSSSSSSS"


@dataclass(frozen=True)
class Typing:
    """How an entity's raw columns are typed. ``decimals`` and ``lenient``: column to (precision, scale)."""

    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)
    lenient: dict[str, tuple[int, int]] = field(default_factory=dict)
    business_date: str | None = None
    more_dates: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    pattern: str = EVENT_PATTERN


def decimal_comma(c: str | Column, precision: int = 14, scale: int = 3, lenient: bool = False) -> Column:
    """Text with a decimal comma as a decimal. Bad text raises, or is null if ``lenient``."""
    point = F.replace(F.col(c) if isinstance(c, str) else c, F.lit(","), F.lit("."))
    kind = f"decimal({precision},{scale})"
    return point.try_cast(kind) if lenient else point.cast(kind)


def parse_timestamp(c: str | Column, *patterns: str) -> Column:
    """The first pattern that fits, else a plain cast, else null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(p)) for p in patterns], c.try_cast("timestamp"))


def apply_typing(df: DataFrame, cfg: Typing) -> DataFrame:
    """All columns typed in one projection; a business date adds ``year`` and ``month``. Configured columns that are absent are skipped."""

    def typed(name: str) -> Column:
        if name in cfg.decimals:
            return decimal_comma(name, *cfg.decimals[name])
        if name in cfg.lenient:
            return decimal_comma(name, *cfg.lenient[name], lenient=True)
        if name == cfg.business_date:
            return F.to_timestamp(F.col(name), cfg.pattern)
        if name in cfg.more_dates:
            return F.try_to_timestamp(F.col(name), F.lit(cfg.pattern))
        return F.col(name)

    out = df.select(*[typed(c).alias(cfg.renames.get(c, c)) for c in df.columns])
    if cfg.business_date in df.columns:
        when = F.col(cfg.renames.get(cfg.business_date, cfg.business_date))
        out = out.select("*", F.year(when).alias("year"), F.month(when).alias("month"))
    return out


def money(c: str | Column, scale: int = 2) -> Column:
    """A double as decimal(14, scale): sums of doubles depend on their order."""
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal(14,{scale})")
