"""Gradient fingerprints of sampled images and their distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gradient_words(samples: Column, width: int, rows: int) -> Column:
    """Bits ``sample < next sample`` along each row, packed into 64-bit words.

    ``samples`` holds ``rows`` rows of ``width`` values. Bit ``row * (width - 1) + col``
    compares columns ``col`` and ``col + 1``.
    """
    bits = rows * (width - 1)
    words = []
    for start in range(0, bits, 64):
        terms = []
        for bit in range(start, min(start + 64, bits)):
            row, col = divmod(bit, width - 1)
            at = row * width + col
            terms.append((at, bit - start))
        steps = F.array(*[F.struct(F.lit(a).alias("at"), F.lit(b).alias("bit")) for a, b in terms])
        words.append(
            F.aggregate(
                steps,
                F.lit(0).cast("bigint"),
                lambda acc, s: acc.bitwiseOR(
                    F.when(
                        F.get(samples, s["at"]) < F.get(samples, s["at"] + 1),
                        F.call_function("shiftleft", F.lit(1).cast("bigint"), s["bit"]),
                    ).otherwise(F.lit(0).cast("bigint"))
                ),
            )
        )
    return F.array(*words)


def gradient_hash(samples: Column, width: int, rows: int) -> Column:
    """The fingerprint as one BIGINT, for at most 64 bits."""
    if rows * (width - 1) > 64:
        raise ValueError("more than 64 bits: use gradient_words")
    return F.get(gradient_words(samples, width, rows), F.lit(0))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hamming_words(a: Column, b: Column) -> Column:
    """The distance of two word arrays of equal length."""
    parts = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(parts, F.lit(0), lambda acc, n: acc + n)
