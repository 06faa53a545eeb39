"""Stateless pseudo-random choices.

Every sampling decision is a pure function of a row key, a seed and, where it
applies, a round. A lost task that runs again therefore decides the same, and a
later job can regenerate the decision from the key alone.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Modulus of the row hash: the Mersenne prime 2^31 - 1. Together with coefficients
# under 2^28 the product stays inside a BIGINT.
PRIME = 2_147_483_647


def seeded_md5(seed: int, *parts: Column | str) -> Column:
    """Hex digest of ``seed:part:part...``; its text order is a random order."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hex_to_bigint(digest: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")


def row_hash(*key: Column | str) -> Column:
    """Integer in ``[0, 2^31 - 1)`` that identifies the row in the sampling rules."""
    cols = [F.col(k) if isinstance(k, str) else k for k in key]
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))
    return hex_to_bigint(digest, 1, 8) % F.lit(PRIME)


def round_coefficients(seed: int, round_no: int) -> tuple[int, int]:
    """Coefficients ``(a, b)`` of the universal hash of one boosting round."""
    digest = hashlib.md5(f"{seed}:{round_no}".encode()).hexdigest()
    return max(1, int(digest[0:7], 16)), int(digest[7:14], 16)


def sample_cutoff(ratio: float) -> int:
    return int(ratio * PRIME)


def in_row_sample(hash_col: Column | str, ratio: float, seed: int, round_no: int) -> Column:
    """Whether a row takes part in boosting round ``round_no``."""
    h = F.col(hash_col) if isinstance(hash_col, str) else hash_col
    a, b = round_coefficients(seed, round_no)
    return (h * F.lit(a) + F.lit(b)) % F.lit(PRIME) < F.lit(sample_cutoff(ratio))
