"""Quality operators: annotate a dataset with failure reasons and status,
split it into valid and rejected rows, flag foreign keys against parents.

Plan shape (per dataset):

* all rule conditions, the reasons array, the status — one Project,
  evaluated inside whole-stage codegen;
* each UNIQUE column adds one partial aggregate (map-side combined, so a
  key holding a third of all rows costs one row per map task in the
  shuffle) and one left join of the duplicated keys back;
* each REFERENCE flag left joins the parent's keys where they are few
  (``FEW_KEYS``); else it finds the dangling keys on key-only data (distinct
  keys anti-joined with the parent's keys) and left joins that exception
  set back.

Exception sets are staged: written once under the shared checkpoint folder
(``session.staged_copy``) while the plan is built.  A set that is small enough
is then broadcast by the planner, which knows the file's size, and the rows of
the dataset are not shuffled at all.  A large one is matched with the key and
the number of each row where the rows have numbers (``numbered``): only these two
columns are shuffled, and the numbers found come back as bits, one a row.  Rows
without numbers are joined to it by sort-merge.  Both joins are between plain scans
or shuffles, the shape in which AQE splits a hot key's rows over tasks.  Null keys
match nothing: they are left out of the first join and in the second dealt out by a
hash of the row instead of meeting in one task.  No side is ever repeated.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.rules import Rule, condition, duplicate_flag_column, failure_reasons, validate
from salesmart.session import staged_copy

# Parts that rows with a null key are dealt to in the joins back; other rows are in part 0.
NULL_PARTS = 1024
_PART = "_dq_part"

# The number of a row (``numbered``), and where the bits of the rows are: row n has bit
# n % 64 of word n / 64 % WORDS in block n / (64 * WORDS).
ROW = "_dq_row"
_BLOCK = "_dq_block"
WORDS = 8
# Up to so many keys a set is left to the planner, which joins it without a shuffle of the rows.
FEW_KEYS = 200_000
# Up to so many blocks (of 72 bytes) are broadcast; more are joined by block number, evenly.
MANY_BLOCKS = 1_000_000

# Rules that take longest for a row: they match or parse its text.
PATTERN_TYPES = ("REGEX", "VALID_CUSTOMER_NAME", "DATE_FORMAT")

PASSED = "PASSED"
REJECTED = "REJECTED"


def load_rule_sets(rules: DataFrame) -> RuleSets:
    """Active rules of every dataset, each in (rule_order, rule_id) order.

    The catalog is control data (tens of rows), so it is collected to the
    driver, where the rules are compiled into column expressions: once for all
    datasets, and without a job where it is a local relation (the shipped
    catalog).  A rule that is not valid stops the run when its dataset's rules
    are asked for (``load_rules``, ``RuleSets``).
    """

    return RuleSets(rules)


class RuleSets(Mapping):
    """``load_rule_sets``: dataset name to validated rules."""

    def __init__(self, rules: DataFrame):
        self._rows: dict[str, list] = {}
        for row in rules.where(rules.is_active).collect():
            self._rows.setdefault(row["dataset_name"], []).append(row)

    def __getitem__(self, dataset_name: str) -> list[Rule]:
        ordered = sorted(self._rows.get(dataset_name, []), key=_rule_place)
        return [validate(Rule.of(row)) for row in ordered]

    def __iter__(self):
        return iter(self._rows)

    def __len__(self) -> int:
        return len(self._rows)


def _rule_place(row) -> tuple:
    """Ascending (rule_order, rule_id), nulls first: the order of ``active_rules_df``."""

    order, rule_id = row["rule_order"], row["rule_id"]
    return (order is not None, order or 0, rule_id is not None, rule_id or "")


def load_rules(rules: DataFrame, dataset_name: str) -> list[Rule]:
    """Active rules of one dataset in evaluation order, validated."""

    return RuleSets(rules.where(rules.dataset_name == dataset_name))[dataset_name]


def _quoted(name: str):
    return F.col(f"`{name}`")


def duplicate_keys(df: DataFrame, key: str, flag: str | None = None) -> DataFrame:
    """Keys occurring more than once (nulls excluded), with a TRUE flag.

    A hash aggregate with partial aggregation: each map task sends one row
    per distinct key it saw, however skewed the key distribution.
    """

    flag = flag or duplicate_flag_column(key)
    return (
        df.select(_quoted(key).alias(key))
        .where(_quoted(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_dq_n"))
        .where(F.col("_dq_n") > 1)
        .select(_quoted(key), F.lit(True).alias(flag))
    )


def join_back(df: DataFrame, exceptions: DataFrame, key: str) -> DataFrame:
    """``df`` left joined to the staged ``exceptions`` (one row a key).

    Rows with a null key, which match nothing, are dealt to ``NULL_PARTS``
    parts by their number, else by a hash of their other columns (so a retried
    task deals them alike).  A number spares the scan what no one else reads."""

    if ROW in df.columns:
        return _join_parts(df, exceptions, key, _quoted(ROW))
    others = [_quoted(f.name) for f in df.schema.fields if f.name != key and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    if not others:
        return df.join(exceptions, on=key, how="left")
    return _join_parts(df, exceptions, key, F.xxhash64(*others))


def _join_parts(df: DataFrame, exceptions: DataFrame, key: str, deal) -> DataFrame:
    part = F.when(_quoted(key).isNull(), F.pmod(deal, F.lit(NULL_PARTS))).otherwise(F.lit(0)).cast("int")
    return df.withColumn(_PART, part).join(exceptions.withColumn(_PART, F.lit(0)), on=[key, _PART], how="left").drop(_PART)


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a number for each row (``ROW``).  The numbers hold only in
    rows that have been written: stage them before use."""

    return df.withColumn(ROW, F.monotonically_increasing_id())


def _row_bit() -> tuple:
    """Of a row's number: its block, the word in the block, the bit in the word."""

    row = _quoted(ROW)
    return F.shiftright(row, 9), F.shiftright(row, 6).bitwiseAND(F.lit(WORDS - 1)), row.bitwiseAND(F.lit(63)).cast("int")


def row_marks(df: DataFrame, exceptions: DataFrame, key: str, flag: str) -> DataFrame:
    """The rows of ``df`` (numbered, staged) whose key is among ``exceptions``, as
    blocks of bits.  Only the key and the number of each row are shuffled."""

    block, word, bit = _row_bit()
    rows = df.select(_quoted(key), _quoted(ROW)).where(_quoted(key).isNotNull())
    found = rows.join(exceptions.select(_quoted(key)), on=key, how="left_semi")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = [F.bit_or(F.when(word == i, one).otherwise(F.lit(0).cast("long"))).alias(_word(flag, i)) for i in range(WORDS)]
    return found.groupBy(block.alias(_BLOCK)).agg(*words)


def _word(flag: str, i: int) -> str:
    return f"{flag}__w{i}"


def join_marks(df: DataFrame, marks: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` with ``flag``: TRUE in the rows that ``marks`` has, else NULL.  As
    after a join on the key, that column comes first."""

    block, word, bit = _row_bit()
    small = marks.count() <= MANY_BLOCKS
    out = df.withColumn(_BLOCK, block).join(F.broadcast(marks) if small else marks, on=_BLOCK, how="left")
    bits = F.coalesce(*[F.when(word == i, _quoted(_word(flag, i))) for i in range(WORDS)])
    others = [_quoted(c) for c in df.columns if c != key]
    return out.select(_quoted(key), *others, F.when(F.getbit(bits, bit) == 1, F.lit(True)).alias(flag))


def flag_back(df: DataFrame, exceptions: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` with ``flag`` of a staged set: of keys, or of marked rows."""

    return join_marks(df, exceptions, key, flag) if _BLOCK in exceptions.columns else join_back(df, exceptions, key)


ExceptionSets = dict[tuple[str, str], DataFrame]
# A parent dataset, or what gives it once it is there; a foreign key, its parent, its flag.
Parent = DataFrame | Callable[[], DataFrame]
Reference = tuple[str, Parent, str]


def _given(parent: Parent) -> DataFrame:
    return parent if isinstance(parent, DataFrame) else parent()


def exception_sets(df: DataFrame, rules: Iterable[Rule], references: Sequence[Reference] = ()) -> ExceptionSets:
    """All staged sets that a dataset's UNIQUE rules and references join back:
    each is an aggregate over key-only data, and their jobs run side by side.

    ``("duplicate", key)``: the duplicated keys; for a reference either
    ``("known", flag)``, the parent's keys where they are few, or ``("dangling",
    flag)``.  A large set of a numbered ``df`` becomes the marks of its rows.  Only
    the references wait for a parent that is not there yet."""

    def duplicates(key):
        found = staged_copy(duplicate_keys(df, key), "duplicate-keys")
        return ("duplicate", key), _of_rows(df, found, key, duplicate_flag_column(key))

    def reference(key, parent, flag):
        known = staged_copy(_distinct(_given(parent), key).withColumn(flag, F.lit(True)), "parent-keys")
        if known.count() <= FEW_KEYS:
            return ("known", flag), known
        found = staged_copy(dangling_keys(df, key, known, _marker(flag)), "dangling-keys")
        return ("dangling", flag), _of_rows(df, found, key, _marker(flag))

    unique = dict.fromkeys(r.column_name for r in rules if r.rule_type == "UNIQUE")
    wanted = [(duplicates, (key,)) for key in unique] + [(reference, r) for r in references]
    if not wanted:
        return {}
    with ThreadPoolExecutor(min(4, len(wanted))) as pool:
        return dict(pool.map(lambda w: w[0](*w[1]), wanted))


def _of_rows(df: DataFrame, found: DataFrame, key: str, flag: str) -> DataFrame:
    """The staged keys ``found``, or the marks of their rows where that spares a
    shuffle of all columns."""

    if ROW not in df.columns or found.count() <= FEW_KEYS:
        return found
    return staged_copy(row_marks(df, found, key, flag), "row-marks", "zstd")


def _marker(flag: str) -> str:
    return f"_dq_dangling__{flag}"


def add_duplicate_flags(df: DataFrame, keys: Iterable[str], sets: ExceptionSets | None = None) -> DataFrame:
    """Append ``_dq_dup__<key>`` (TRUE if the key is duplicated) per key."""

    out, columns = df, list(df.columns)
    keys = list(dict.fromkeys(keys))
    if sets is None:
        sets = exception_sets(df, [Rule("UNIQUE", k, "DUPLICATE") for k in keys])
    for key in keys:
        flag = duplicate_flag_column(key)
        out = flag_back(out, sets["duplicate", key], key, flag)
        columns.append(flag)
    return out.select(*[_quoted(c) for c in columns])


def dangling_keys(df: DataFrame, key: str, parent: DataFrame, marker: str = "_dq_dangling") -> DataFrame:
    """Distinct non-null keys of ``df`` that ``parent`` does not have.

    Only key columns move: both sides are partially aggregated to distinct
    keys before the anti join, so the cost is a shuffle of keys, never of
    the rows of ``df``.
    """

    used, known = _distinct(df, key), _distinct(parent, key)
    return used.join(known, on=key, how="left_anti").select(_quoted(key), F.lit(True).alias(marker))


def _distinct(df: DataFrame, key: str) -> DataFrame:
    return df.select(_quoted(key).alias(key)).where(_quoted(key).isNotNull()).distinct()


REFERENCE_STRATEGIES = ("exceptions", "join")


def flag_references(
    df: DataFrame,
    references: Sequence[Reference],
    strategy: str = "exceptions",
    sets: ExceptionSets | None = None,
) -> DataFrame:
    """For each ``(key, parent, flag)``: ``flag`` is TRUE where the key exists
    among the parent's keys and NULL otherwise (also for a NULL key).

    ``strategy="exceptions"`` (for table-backed inputs, the default): the
    parent's keys are staged; few (``FEW_KEYS``) are left joined as they are.
    Else the *dangling* keys (used but unknown) are found on key-only data,
    staged, and joined back.  A parent rejected for any reason makes all its rows
    dangle, so the set can be large; see the module's text for both cases.  The
    key-only branch re-reads ``df``: a columnar scan when ``df`` is a table.

    ``strategy="join"``: the parent's distinct keys are staged and left joined
    (one branch over ``df``).  Cheaper when ``df`` is a long lazy plan that a
    second branch would derive again.

    Output columns follow the original engine's USING joins: the keys move
    to the front, the last-joined key first; the flags are appended.
    """

    if strategy not in REFERENCE_STRATEGIES:
        raise ValueError(f"Unknown reference strategy: {strategy}")
    out = df
    if sets is None and strategy == "exceptions":
        sets = exception_sets(df, [], references)
    for key, parent, flag in references:
        if strategy == "join":
            out = join_back(out, staged_copy(_distinct(_given(parent), key).withColumn(flag, F.lit(True)), "parent-keys"), key)
            continue
        if ("known", flag) in sets:
            out = join_back(out, sets["known", flag], key)
            continue
        marker = _marker(flag)
        out = (
            flag_back(out, sets["dangling", flag], key, marker)
            .withColumn(flag, F.when(_quoted(key).isNotNull() & _quoted(marker).isNull(), F.lit(True)))
            .drop(marker)
        )
    return out


def annotate(
    df: DataFrame,
    rules: Iterable[Rule | Mapping],
    as_of: _dt.date | None = None,
    sets: ExceptionSets | None = None,
    passed_only: bool = False,
) -> DataFrame:
    """Append ``dq_failure_reasons`` (array<string>, ordered set), ``dq_status``
    (PASSED iff no reason) and ``dq_checked_timestamp``.  ``sets``: exception
    sets at hand, of the same rows.  ``passed_only``: the rows without a reason, by
    a filter for each rule, which is taken to the scan or join that has its columns
    and ends at a row's first failing rule (for a ``df`` that is a plain scan: the
    filters would repeat the expressions of a derived column)."""

    rules = [validate(Rule.of(r)) for r in rules]
    columns = list(df.columns)
    unique_keys = [r.column_name for r in rules if r.rule_type == "UNIQUE"]
    work = add_duplicate_flags(df, unique_keys, sets) if unique_keys else df
    # patterns are matched last, in the rows that pass all else
    for rule in sorted(rules, key=lambda r: r.rule_type in PATTERN_TYPES) if passed_only else ():
        work = work.where(condition(rule, as_of))
    with_reasons = work.select(
        *[_quoted(c) for c in columns],
        failure_reasons(rules, as_of).alias("dq_failure_reasons"),
    )
    return with_reasons.select(
        "*",
        F.when(F.size("dq_failure_reasons") == 0, F.lit(PASSED)).otherwise(F.lit(REJECTED)).alias("dq_status"),
        F.current_timestamp().alias("dq_checked_timestamp"),
    )


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): disjoint and exhaustive, status is two-valued."""

    return (
        annotated.where(F.col("dq_status") == PASSED),
        annotated.where(F.col("dq_status") == REJECTED),
    )


def apply_rules(
    df: DataFrame,
    rules: Iterable[Rule | Mapping],
    as_of: _dt.date | None = None,
) -> tuple[DataFrame, DataFrame]:
    """annotate + split."""

    return split(annotate(df, rules, as_of))


def status_counts(annotated: DataFrame) -> DataFrame:
    """Rows per status."""

    return annotated.groupBy("dq_status").agg(F.count(F.lit(1)).alias("row_count"))


def reason_counts(annotated: DataFrame) -> DataFrame:
    """Rows per failure reason (a row with several reasons counts for each)."""

    return (
        annotated.select(F.explode("dq_failure_reasons").alias("failure_reason"))
        .groupBy("failure_reason")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def rule_failure_counts(
    df: DataFrame,
    rules: Iterable[Rule | Mapping],
    as_of: _dt.date | None = None,
    sets: ExceptionSets | None = None,
) -> DataFrame:
    """One row per rule: its id, dataset, type, column, reason and the number
    of rows failing it.

    All rules are counted in ONE aggregate over the data (a single scan
    and one partial/final aggregation), then unpivoted into rows.  ``sets``:
    exception sets at hand, of the same rows.
    """

    rules = [validate(Rule.of(r)) for r in rules]
    unique_keys = [r.column_name for r in rules if r.rule_type == "UNIQUE"]
    work = add_duplicate_flags(df, unique_keys, sets) if unique_keys else df
    counts = work.agg(*[
        F.count_if(~F.coalesce(condition(r, as_of), F.lit(False))).alias(f"_n{i}")
        for i, r in enumerate(rules)
    ])
    rows = F.array(*[
        F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.dataset_name).alias("dataset_name"),
            F.lit(r.rule_type).alias("rule_type"),
            F.lit(r.column_name).alias("column_name"),
            F.lit(r.failure_reason).alias("failure_reason"),
            F.col(f"_n{i}").alias("failed_rows"),
        )
        for i, r in enumerate(rules)
    ])
    return counts.select(F.inline(rows))
