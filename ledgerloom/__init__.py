"""ledgerloom: commerce and CRM analytics as Spark DataFrame operators.

Every model is a function ``f(ds, as_of) -> DataFrame`` over a lazy
:class:`~ledgerloom.sources.datasets.Datasets` registry; nothing is collected
to the driver and every result is a plain Catalyst plan.
"""

from ledgerloom.sources.datasets import Datasets  # noqa: F401

__all__ = ["Datasets"]
