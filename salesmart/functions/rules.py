"""Rule records and the rule compiler: one rule row -> one boolean Column.

A compiled condition that is TRUE means *pass*.  A condition that evaluates
to SQL NULL counts as a failure (the annotator wraps every condition in
``coalesce(cond, false)``).  Every type except NOT_NULL lets a null value
pass, so a missing value is reported once, by its NOT_NULL rule.

All conditions are built-in Catalyst expressions: they run inside
whole-stage codegen, no Python per row.  Rule parameters (JSON lists and
ranges) are decoded once on the driver while compiling.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — must equal the original engine's for identical results.
# VALID_STATE accepts exactly these 51 names (50 states + District of
# Columbia), case-sensitive, in alphabetical order.
US_STATES = [
    "Alabama", "Alaska", "Arizona", "Arkansas", "California",
    "Colorado", "Connecticut", "Delaware", "District of Columbia",
    "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana",
    "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland",
    "Massachusetts", "Michigan", "Minnesota", "Mississippi",
    "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire",
    "New Jersey", "New Mexico", "New York", "North Carolina",
    "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania",
    "Rhode Island", "South Carolina", "South Dakota", "Tennessee",
    "Texas", "Utah", "Vermont", "Virginia", "Washington",
    "West Virginia", "Wisconsin", "Wyoming",
]
# VALID_CUSTOMER_NAME: Unicode letters, space, dot, apostrophe, hyphen.
CUSTOMER_NAME_PATTERN = r"^[\p{L} .'\-]+$"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One data-quality rule.  Only type, column and reason are required."""

    rule_type: str
    column_name: str
    failure_reason: str
    rule_parameter: str | None = None
    rule_id: str = ""
    rule_order: int = 0
    dataset_name: str = ""

    @classmethod
    def of(cls, obj) -> "Rule":
        if isinstance(obj, Rule):
            return obj
        get = obj.asDict().get if hasattr(obj, "asDict") else obj.get
        return cls(
            rule_type=get("rule_type"),
            column_name=get("column_name"),
            failure_reason=get("failure_reason"),
            rule_parameter=get("rule_parameter"),
            rule_id=get("rule_id") or "",
            rule_order=get("rule_order") or 0,
            dataset_name=get("dataset_name") or "",
        )


def duplicate_flag_column(column_name: str) -> str:
    """Helper column holding TRUE for rows whose key occurs more than once."""

    return f"_dq_dup__{column_name}"


def _param_json(rule: Rule):
    try:
        return json.loads(rule.rule_parameter)
    except (TypeError, ValueError) as error:
        raise ValueError(
            f"Rule {rule.rule_id or rule.column_name}: parameter of "
            f"{rule.rule_type} must be JSON, got {rule.rule_parameter!r}"
        ) from error


def _allowed_values(rule: Rule) -> list:
    values = _param_json(rule)
    if not isinstance(values, list):
        raise ValueError(f"ALLOWED_VALUES needs a JSON array: {rule.rule_parameter!r}")
    return values


def _bounds(rule: Rule) -> tuple:
    limits = _param_json(rule)
    if not isinstance(limits, dict) or "min" not in limits or "max" not in limits:
        raise ValueError(f"BETWEEN needs {{\"min\", \"max\"}}: {rule.rule_parameter!r}")
    return limits["min"], limits["max"]


def _needs_parameter(rule: Rule) -> None:
    if rule.rule_parameter is None or rule.rule_parameter == "":
        raise ValueError(f"{rule.rule_type} rule on {rule.column_name} needs a parameter")


def _today(as_of: _dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


# rule_type -> (validate(rule), compile(value, rule, as_of) -> Column)
_REGISTRY: dict[str, tuple[Callable, Callable]] = {
    "NOT_NULL": (
        lambda r: None,
        lambda v, r, a: v.isNotNull(),
    ),
    "UNIQUE": (
        lambda r: None,
        lambda v, r, a: v.isNull()
        | ~F.coalesce(F.col(duplicate_flag_column(r.column_name)), F.lit(False)),
    ),
    "REGEX": (
        _needs_parameter,
        lambda v, r, a: v.isNull() | v.rlike(r.rule_parameter),
    ),
    "VALID_CUSTOMER_NAME": (
        lambda r: None,
        lambda v, r, a: v.isNull() | v.rlike(CUSTOMER_NAME_PATTERN),
    ),
    "ALLOWED_VALUES": (
        _allowed_values,
        lambda v, r, a: v.isNull() | v.isin(_allowed_values(r)),
    ),
    "VALID_STATE": (
        lambda r: None,
        lambda v, r, a: v.isNull() | v.isin(US_STATES),
    ),
    "POSITIVE": (
        lambda r: None,
        lambda v, r, a: v.isNull() | (v > 0),
    ),
    "BETWEEN": (
        _bounds,
        lambda v, r, a: v.isNull() | v.between(F.lit(_bounds(r)[0]), F.lit(_bounds(r)[1])),
    ),
    "DATE_FORMAT": (
        _needs_parameter,
        lambda v, r, a: v.isNull()
        | F.try_to_timestamp(v, F.lit(r.rule_parameter)).isNotNull(),
    ),
    "NOT_FUTURE": (
        lambda r: None,
        lambda v, r, a: v.isNull() | (v <= _today(a)),
    ),
    "COLUMN_GTE": (
        _needs_parameter,
        lambda v, r, a: v.isNull()
        | F.col(r.rule_parameter).isNull()
        | (v >= F.col(r.rule_parameter)),
    ),
    "REFERENCE": (
        _needs_parameter,
        lambda v, r, a: v.isNull() | F.coalesce(F.col(r.rule_parameter), F.lit(False)),
    ),
}

RULE_TYPES = tuple(_REGISTRY)


def validate(rule: Rule) -> Rule:
    """Reject rules that cannot be compiled, before any data is touched."""

    if rule.rule_type not in _REGISTRY:
        raise ValueError(f"Unsupported rule type: {rule.rule_type}")
    if not rule.column_name:
        raise ValueError(f"Rule {rule.rule_id or rule.rule_type} has no column")
    if rule.failure_reason is None or rule.failure_reason == "":
        raise ValueError(f"Rule {rule.rule_id or rule.rule_type} has no failure_reason")
    _REGISTRY[rule.rule_type][0](rule)
    return rule


def condition(rule: Rule | Mapping, as_of: _dt.date | None = None) -> Column:
    """Compile one rule into its pass condition."""

    rule = validate(Rule.of(rule))
    return _REGISTRY[rule.rule_type][1](F.col(rule.column_name), rule, as_of)


def failure_reasons(rules: Iterable[Rule | Mapping], as_of: _dt.date | None = None) -> Column:
    """One expression for all rules: the ordered set of failure reasons.

    ``array_compact`` drops the reasons of passing rules and
    ``array_distinct`` keeps a reason once, at its first position — the
    same result as appending reasons rule by rule with set semantics, but
    as a single projection instead of one per rule.
    """

    return _failure_reasons(tuple(validate(Rule.of(r)) for r in rules), as_of, _jvm_id())


def _jvm_id() -> str:
    from pyspark import SparkContext

    sc = SparkContext._active_spark_context
    return f"{id(sc)}:{sc.applicationId}" if sc is not None else "none"


@lru_cache(maxsize=128)
def _failure_reasons(rules: tuple[Rule, ...], as_of, _jvm: str) -> Column:
    # Compiled once per rule list (and JVM): column expressions are
    # unresolved, so the same Column is reused by every plan built on it.
    checks = [F.when(~F.coalesce(condition(r, as_of), F.lit(False)), F.lit(r.failure_reason)) for r in rules]
    if not checks:
        return F.array().cast("array<string>")
    reasons = F.array_compact(F.array(*checks))
    # The per-row de-duplication is only needed when two rules share a reason.
    shared = len({r.failure_reason for r in rules}) < len(rules)
    return F.array_distinct(reasons) if shared else reasons
