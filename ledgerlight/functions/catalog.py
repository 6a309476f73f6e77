"""The class functions as SQL functions of the session's catalog, named in statements and replaced by name.

The source's UPDATE calls three warehouse functions whose names are run
parameters.  ``register_class_functions`` creates them as SQL scalar functions
(``CREATE TEMPORARY FUNCTION ... RETURN``), which Spark inlines into the plan of
the statement that names them.  A caller replaces one by giving another body, or
names any other function of the catalog.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import SparkSession

from . import rules

#: Default names of the functions that an UPDATE calls, by what they classify.
CLASS_FUNCTIONS = {"device": "class_device", "advertiser": "class_advertiser", "vehicle": "class_vehicle"}


def class_bodies() -> dict[str, str]:
    """SQL expression over ``value`` of each class function: the rule sets of P11 and P12, and the vehicle as it is."""
    return {"device": rules.sql_rules(rules.DEVICE_RULES_A, {"device": "value"}, rules.DEVICE_DEFAULT),
            "advertiser": rules.sql_rules(rules.ADVERTISER_RULES_A, {"campaign": "value"}, rules.ADVERTISER_DEFAULT_A),
            "vehicle": "value"}


def register_class_functions(spark: SparkSession, bodies: Mapping[str, str] | None = None,
                             names: Mapping[str, str] | None = None) -> dict[str, str]:
    """Creates or replaces the class functions; ``bodies`` and ``names`` override single ones.  Returns the names by kind."""
    called = {**CLASS_FUNCTIONS, **(names or {})}
    for kind, body in {**class_bodies(), **(bodies or {})}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION `{called[kind]}`(value STRING) RETURNS STRING RETURN {body}")
    return called
