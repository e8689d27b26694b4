"""panelkit: panel-table profiling and binary-classifier evaluation on Spark DataFrames.

Every operator takes DataFrames (plus a small spec) and returns a lazy
DataFrame built from native Spark expressions, so Catalyst can prune,
push down and fuse the work.  Sub-packages:

* ``sources``    – readers, writers and the test-table panel derivations
* ``functions``  – reusable column expressions, exact quantiles, ordered prefix sums
* ``operators``  – the profiling / split / feature / evaluation / check operators
* ``plans``      – named end-to-end queries over the test tables and their SQL oracles
* ``streaming``  – intentionally empty (the reference has no streaming path)
"""

from panelkit.spec import AmountPolicy, BILL_POLICY, PAYMENT_POLICY, CodeBook, PanelSpec

__all__ = ["AmountPolicy", "BILL_POLICY", "PAYMENT_POLICY", "CodeBook", "PanelSpec"]
