"""Column-expression helpers. All of them are built-in Spark expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohort.constants import PSEUDONYM_HEX_DIGITS, PSEUDONYM_SEP


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bucket(salt: str, expr, n: int = 100) -> Column:
    """Stable pseudo-random integer in ``[0, n)`` from ``md5(salt|expr)``.

    Replaces ``randomSplit``/RNG draws: the value depends only on the key, so
    it is identical across partitionings, retries and engines (the DuckDB twin
    is ``('0x'||substr(md5(k),1,8))::BIGINT % n``).
    """
    key = F.concat(F.lit(f"{salt}|"), _c(expr).cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(n)


def pseudonymize(*parts, salt: str | None = None) -> Column:
    """Irreversible short id: first 16 hex digits of sha1 over the joined parts.

    With ``salt`` the salt is prepended as the first part, so the same raw
    value maps to different ids under different salts.
    """
    cols = [_c(p).cast("string") for p in parts]
    if salt is not None:
        cols = [F.lit(salt)] + cols
    joined = cols[0] if len(cols) == 1 else F.concat(*[x for c in cols for x in (F.lit(PSEUDONYM_SEP), c)][1:])
    return F.substring(F.sha1(joined), 1, PSEUDONYM_HEX_DIGITS)


def is_allowed(gdpr_consent="gdpr_consent", ccpa_opt_out="ccpa_opt_out") -> Column:
    """Processing allowed = GDPR consent given and no CCPA opt-out.

    Null consent means *not allowed*; a null opt-out counts as opted out.
    """
    return F.coalesce(_c(gdpr_consent), F.lit(False)) & ~F.coalesce(_c(ccpa_opt_out), F.lit(True))


def choose2(n) -> Column:
    """Number of unordered pairs among ``n`` items, as bigint (no pair explosion).

    The even factor is halved first, so the product fits in 64 bits up to n = 4.2e9.
    """
    n = _c(n).cast("bigint")
    even = n % 2 == 0
    return F.when(even, F.shiftright(n, 1) * (n - 1)).otherwise(n * F.shiftright(n - 1, 1))


def binary_entropy(p, clip: float = 1e-15) -> Column:
    """-(p ln p + (1-p) ln(1-p)) with p clipped to [clip, 1-clip]; 0 for p in {0,1}."""
    p = _c(p)
    pc = F.least(F.greatest(p, F.lit(clip)), F.lit(1 - clip))
    h = -(pc * F.log(pc) + (1 - pc) * F.log(1 - pc))
    return F.when((p <= 0) | (p >= 1), F.lit(0.0)).otherwise(h)
