"""Column-expression helpers (inventory section S). All stay JVM-side."""

from quiver.functions.common import arr_text, r6, md5_bucket, round_even  # noqa: F401
