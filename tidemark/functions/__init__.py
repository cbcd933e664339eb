"""Column builders of the features, one module per family.

Builders take a `Frame`, which knows how a series is partitioned and ordered, and return Columns; undefined values are
NULL, never NaN.
"""

from .frame import Frame, clamp, positive, ratio

__all__ = ["Frame", "clamp", "positive", "ratio"]
