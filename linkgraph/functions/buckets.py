"""Host buckets: which of n nodes owns a host."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Width of the hash space in bits and in hex digits.
HASH_BITS = 160
HASH_DIGITS = 40


def bucket_bounds(n: int) -> list[str]:
    """Lower ends of buckets 1..n-1, as hex text that orders like the number."""
    width = (1 << HASH_BITS) // n
    return [format(width * i, f"0{HASH_DIGITS}x") for i in range(1, n)]


def host_bucket(host: Column, n: int) -> Column:
    """Bucket 0..n-1 of the SHA-1 of ``host`` over n equal ranges of the hash space.

    The leading digits give the bucket but for hashes just below a bound; comparing with that one
    bound makes it exact, so the work per row does not grow with n.
    """
    if n == 1:
        return F.when(host.isNotNull(), F.lit(0))
    digest = F.sha1(host)
    digits = (62 - n.bit_length()) // 4
    head = F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")
    guess = F.shiftright(head * n, 4 * digits)
    upper = F.get(F.array(*[F.lit(b) for b in bucket_bounds(n)]), guess.cast("int"))
    return (guess + F.coalesce((digest >= upper).cast("int"), F.lit(0))).cast("int")
