"""adlens - campaign analytics as Spark DataFrame functions.

Typed campaign / user / click / session / conversion / daily-cost tables, integrity
audits, derived views (enriched sessions, campaign-day KPIs, click cohorts), range
reports, breakdowns, cohort lift and a batch upsert of daily costs.

Sub-packages:

* ``sources``   - schemas, typed loaders, the driver test-data mapping, model store
* ``functions`` - column expressions: exact ratios, lift, date helpers
* ``operators`` - DataFrame -> DataFrame building blocks and user-facing reports
* ``plans``     - the named-query catalog and plan-inspection helpers
* ``streaming`` - how a stream of cost feeds uses the batch upsert
"""

from adlens.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
