"""Text helpers for summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_label(separator: str, *parts: Column) -> Column:
    """Parts joined by the separator; null and empty parts leave no gap."""
    return F.concat_ws(separator, *[F.nullif(part, F.lit("")) for part in parts])


def readable_size(n_bytes: Column) -> Column:
    """Binary size with one decimal, halves rounded to even, such as ``1.5 MiB``; plain bytes below 1 KiB."""
    n_bytes = n_bytes.cast("double")
    text = F.when(n_bytes == 1, F.lit("1 Byte"))
    text = text.when(n_bytes < 1024, F.concat(F.format_string("%.0f", n_bytes), F.lit(" Bytes")))
    units = ("KiB", "MiB", "GiB", "TiB", "PiB")
    for power, unit in enumerate(units, start=1):
        scaled = F.concat(F.format_string("%.1f", F.bround(n_bytes / float(1024**power), 1)), F.lit(f" {unit}"))
        text = text.otherwise(scaled) if unit == units[-1] else text.when(n_bytes < 1024.0 ** (power + 1), scaled)
    return text


def gibibytes(n_bytes: Column) -> Column:
    return n_bytes / float(1024**3)
