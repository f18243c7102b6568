"""arenaflow: match-log feature extraction expressed as Spark DataFrame plans.

Layout
------
``params``      typed, validated run parameters (dates, modes, hero, thresholds).
``schemas``     declared ``StructType`` schemas of the three logs.
``functions``   reusable ``Column`` builders (date keys, version validity, packing).
``sources``     log scans, the test-table adapter, keyed text export and read-back,
                framed binary records.
``operators``   one ``DataFrame -> DataFrame`` function per inventory operator.
``plans``       the composite jobs (match export, participant export, participant
                detail, monthly QA, wide match view).
``streaming``   incremental landing of JSON logs into date-partitioned Parquet.
"""

from arenaflow.params import RunParams

__all__ = ["RunParams"]
