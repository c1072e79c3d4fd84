"""Measurement rules: units, qualifiers, endpoint types, intervals, and the label of a measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..sources.shared import written
from .text import cleaned, col, extracted, first_text, label_token, lookup, tail

# Fixed values of the measurement vocabulary.
UNIT_SYMBOL_CURIE = {"M": "UO:0000062", "MM": "UO:0000063", "UM": "UO:0000064", "NM": "UO:0000065", "PM": "UO:0000066"}
UNIT_LABEL = {"UO:0000062": "molar", "UO:0000063": "millimolar", "UO:0000064": "micromolar", "UO:0000065": "nanomolar", "UO:0000066": "picomolar", "UO:0000273": "milligram per liter", "UO:0000274": "microgram per milliliter"}
UNIT_MOLAR = {"UO:0000062": 1.0, "UO:0000063": 1e-3, "UO:0000064": 1e-6, "UO:0000065": 1e-9, "UO:0000066": 1e-12, "M": 1.0, "MM": 1e-3, "UM": 1e-6, "NM": 1e-9, "PM": 1e-12}
ENDPOINT_FAMILY = {"IC50": "inhibition_potency", "Ki": "inhibition_affinity", "Kd": "binding_affinity", "EC50": "functional_potency", "AC50": "screening_activity", "Km": "enzyme_kinetics", "INH": "generic_inhibition", "Potency": "generic_potency", "Activity": "generic_activity"}
POTENCY_SCALE = {"IC50": "pIC50", "Ki": "pKi", "Kd": "pKd", "EC50": "pEC50", "AC50": "pAC50", "Km": "pKm"}
LABELLED_TYPES = ("IC50", "Ki", "Kd", "EC50", "AC50")
_BEFORE, _AFTER = r"(?i)(^|[^A-Z0-9])", r"([^A-Z0-9]|$)"
TYPE_PATTERNS = {
    "IC50": r"P?\s*IC[\s_-]*50",
    "EC50": r"P?\s*EC[\s_-]*50",
    "AC50": r"P?\s*AC[\s_-]*50",
    "Ki": r"P?\s*K[\s_-]*I",
    "Kd": r"P?\s*K[\s_-]*D",
    "Km": r"P?\s*K[\s_-]*M",
    "INH": r"INH(IBITION)?",
    "Potency": r"POTENCY",
    "Activity": r"ACTIVITY",
}
QUALIFIERS = {
    "eq": ("=", "==", "EQ", "EQUAL", "EXACT"),
    "lt": ("<", "LT", "LESS_THAN"),
    "le": ("<=", "LE", "LTE", "LESS_THAN_OR_EQUAL"),
    "gt": (">", "GT", "GREATER_THAN"),
    "ge": (">=", "GE", "GTE", "GREATER_THAN_OR_EQUAL"),
    "approx": ("~", "≈", "APPROX", "APPROXIMATE", "ABOUT"),
    "range": ("RANGE", "BETWEEN"),
}
OUTCOMES = {"active": ("ACTIVE", "HIT", "POSITIVE"), "inactive": ("INACTIVE", "NO_ACTIVITY", "NOT_ACTIVE", "NEGATIVE"), "inconclusive": ("INCONCLUSIVE", "INDETERMINATE", "AMBIGUOUS"), "unspecified": ("UNSPECIFIED",)}
NUMBER = r"(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][-+]?\d+)?"
LEADING = r"^\s*(<=|>=|<|>|=|~|≈|≤|≥)\s*"
RANGE = rf"(?i)^\s*\+?({NUMBER})\s*(?:-|–|—|\bto\b)\s*\+?({NUMBER})\s*$"


def _inverse(table: dict[str, tuple[str, ...]]) -> dict[str, str]:
    return {word: name for name, words in table.items() for word in words}


def unit_curie(c: Column | str) -> Column:
    """The unit's CURIE: from a CURIE (padded to seven digits), an ontology address or a symbol; else null."""
    text = cleaned(c)
    ident = F.substring_index(text, ":", -1)
    padded = F.when(ident.rlike(r"^\d{1,6}$"), F.lpad(ident, 7, "0")).otherwise(ident)
    symbol = F.regexp_replace(F.upper(text), "MICROMOLAR|MICRO MOLAR", "UM")
    symbol = F.regexp_replace(symbol, "[\u039c\u00b5]M", "UM")
    address = r"/obo/([A-Za-z]+)_(\d+)$"
    return (
        F.when(F.upper(text).startswith("UO:"), F.concat(F.lit("UO:"), padded))
        .when(text.rlike(address), F.concat(F.upper(F.regexp_extract(text, address, 1)), F.lit(":"), F.regexp_extract(text, address, 2)))
        .otherwise(lookup(symbol, UNIT_SYMBOL_CURIE))
    )


def to_molar(value: Column, unit: Column | str) -> Column:
    """A concentration in mol per litre; null for a unit that is none."""
    key = F.coalesce(unit_curie(unit), F.translate(F.upper(cleaned(unit)), "\u00b5\u039c", "UU"))
    return value * lookup(key, UNIT_MOLAR)


def endpoint_type(*values: Column | str) -> Column:
    """The first endpoint type that one of the values names, values in order."""
    any_type = _BEFORE + "(" + "|".join(TYPE_PATTERNS.values()) + ")" + _AFTER
    each = lambda v: F.coalesce(*(F.when(cleaned(v).rlike(_BEFORE + p + _AFTER), name) for name, p in TYPE_PATTERNS.items()))
    one = lambda v: F.when(cleaned(v).rlike(any_type), each(v))
    return F.coalesce(*map(one, values))


def reported_scale(*values: Column | str) -> Column:
    """``negative_log10_molar`` if a value names a pX quantity, else ``concentration``."""
    named = [F.coalesce(F.upper(F.regexp_replace(cleaned(v), r"[\s_-]+", "")).rlike("P(?:IC50|EC50|AC50|KI|KD|KM)"), F.lit(False)) for v in values]
    found = named[0]
    for other in named[1:]:
        found = found | other
    return F.when(found, "negative_log10_molar").otherwise("concentration")


def qualifier(c: Column | str, raw_value: Column | str) -> Column:
    """eq, lt, le, gt, ge, approx, range or unknown: the qualifier, else the sign before the value, else eq."""
    text = F.coalesce(cleaned(c), extracted(col(raw_value).cast("string"), LEADING))
    key = F.translate(F.upper(F.trim(tail(text, "#", "/"))), "- ", "__")
    key = F.replace(F.replace(key, F.lit("≤"), F.lit("<=")), F.lit("≥"), F.lit(">="))
    return F.when(text.isNull() | (key == ""), "eq").otherwise(F.coalesce(lookup(key, _inverse(QUALIFIERS)), F.lit("unknown")))


def parsed_number(c: Column | str) -> Column:
    """The first number anywhere in a text."""
    return extracted(col(c).cast("string"), f"([-+]?{NUMBER})").try_cast("double")


def parsed_range(c: Column | str) -> Column:
    """``a-b`` or ``a to b`` as a struct of low and high; null if it is no range."""
    text = F.regexp_replace(col(c).cast("string"), LEADING, "")
    a, b = (F.regexp_extract(text, RANGE, k).try_cast("double") for k in (1, 2))
    return F.when(text.rlike(RANGE), F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")))


def outcome_label(c: Column | str) -> Column:
    """A declared outcome as active, inactive, inconclusive or unspecified; else its endpoint type or lower text."""
    text = F.trim(F.translate(F.trim(tail(cleaned(c), "#", "/")), "_-", "  "))
    key = F.translate(F.upper(text), " ", "_")
    return F.when(text != "", F.coalesce(lookup(key, _inverse(OUTCOMES)), endpoint_type(text), F.lower(text)))


#: Statuses under which a value has a molar interval.
NORMALIZED = ("normalized_concentration", "normalized_concentration_range", "normalized_existing_molar", "normalized_log_molar", "normalized_log_molar_range")


#: What measurements' words give, by ``_with_terms``.
TERMS = ("_type_raw", "_type", "_scale", "_unit", "_curie", "_molar_unit", "_unit_label", "_qualifier", "_outcome_label")


def _with_terms(df: DataFrame) -> DataFrame:
    """``df`` with what its words for type, unit, qualifier and outcome mean. Words are few, so each distinct combination
    is looked at once and joined back. They are written first: Spark then knows that they are few and broadcasts them, where it would
    shuffle ``df`` by its words while it finds out."""
    words = [c for c in ("endpoint_type", "unit", "qualifier", "outcome") if c in df.columns]
    known = written(df.select(*(F.col(c).cast("string").alias(f"_word_{c}") for c in words), F.lit(True).alias("_words")).distinct(), "words")
    get = lambda name: F.col(f"_word_{name}") if name in words else F.lit(None).cast("string")
    given, outcome, unit = cleaned(get("endpoint_type")), cleaned(get("outcome")), cleaned(get("unit"))
    curie = unit_curie(unit)
    known = known.withColumns(
        {
            "_type_raw": first_text(given, outcome),
            "_type": endpoint_type(given, outcome),
            "_scale": reported_scale(first_text(given, outcome), outcome),
            "_unit": unit,
            "_curie": curie,
            "_molar_unit": to_molar(F.lit(1.0), unit),
            "_unit_label": F.coalesce(lookup(curie, UNIT_LABEL), curie, unit),
            "_qualifier": F.when(cleaned(get("qualifier")).isNotNull(), qualifier(get("qualifier"), F.lit(None).cast("string"))),
            "_outcome_label": outcome_label(outcome),
        }
    )
    same = F.lit(True)
    for c in words:
        same = same & F.col(c).cast("string").eqNullSafe(F.col(f"_word_{c}"))
    return df.join(known, same).drop("_words", *(f"_word_{c}" for c in words))


def with_normalized_endpoint(df: DataFrame) -> DataFrame:
    """Add the normalised fields of measurements.

    Reads ``endpoint_id, endpoint_type, value, unit, qualifier, outcome`` (texts; a missing column counts as null) and
    ``value_molar`` where it exists. The endpoint's type is taken as given text and inferred; the raw fields stay.
    """
    there = set(df.columns)
    get = lambda name: F.col(name) if name in there else F.lit(None).cast("string")
    numeric = "value" in there and isinstance(df.schema["value"].dataType, NumericType)
    df = _with_terms(df).withColumns({"_given_molar": get("value_molar").cast("double"), "_value": get("value").cast("string")})
    value, unit = F.col("_value"), F.col("_unit")
    number = get("value").cast("double")
    df = df.withColumns(
        {
            "endpoint_type_raw": F.col("_type_raw"),
            "endpoint_type": F.coalesce(F.col("_type"), endpoint_type(get("endpoint_id"))),
            "reported_scale": F.col("_scale"),
            "value_float": F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number) if numeric else parsed_number(value),
            "unit_curie": F.col("_curie"),
            "value_range": F.lit(None).cast("struct<low:double,high:double>") if numeric else parsed_range(value),
            "outcome_label_normalized": F.col("_outcome_label"),
        }
    )
    is_range = F.col("value_range").isNotNull()
    log = F.col("reported_scale") == "negative_log10_molar"
    number, low, high = F.col("value_float"), F.col("value_range.low"), F.col("value_range.high")
    df = df.withColumns(
        {
            "endpoint_family": lookup(F.col("endpoint_type"), ENDPOINT_FAMILY),
            "potency_scale_name": lookup(F.col("endpoint_type"), POTENCY_SCALE),
            "unit_label": F.col("_unit_label"),
            "qualifier_normalized": F.when(is_range, "range").otherwise(F.coalesce(F.col("_qualifier"), F.lit("eq") if numeric else qualifier(F.lit(None).cast("string"), value))),
            "_status": F.when(number.isNotNull() & log & (number <= 0), "invalid_log_potency_value")
            .when(number.isNotNull() & log & F.col("unit_curie").isNotNull(), "conflicting_log_scale_and_concentration_unit")
            .when(number.isNotNull() & log, "normalized_log_molar")
            .when(number <= 0, "nonpositive_value")
            .when(number.isNotNull() & unit.isNull(), "missing_unit")
            .when(number.isNotNull() & (number * F.col("_molar_unit")).isNull(), "unsupported_unit")
            .when(number.isNotNull(), "normalized_concentration")
            .when(F.isnan("_given_molar") | (F.abs("_given_molar") == float("inf")), "non_finite_value")
            .when(F.col("_given_molar") <= 0, "nonpositive_value")
            .when(F.col("_given_molar").isNotNull(), "normalized_existing_molar")
            .otherwise("missing_numeric_value"),
        }
    )
    molar = (
        F.when(F.col("_status") == "normalized_log_molar", F.pow(F.lit(10.0), -number))
        .when(F.col("_status") == "normalized_concentration", (number * F.col("_molar_unit")))
        .when(F.col("_status") == "normalized_existing_molar", F.col("_given_molar"))
    )
    wide = (
        F.when(is_range & ~log & unit.isNotNull() & (low > 0) & (low * F.col("_molar_unit")).isNotNull(), F.struct((low * F.col("_molar_unit")).alias("low"), (high * F.col("_molar_unit")).alias("high")))
        .when(is_range & log & F.col("unit_curie").isNull() & (low > 0), F.struct(F.pow(F.lit(10.0), -high).alias("low"), F.pow(F.lit(10.0), -low).alias("high")))
    )
    df = df.withColumns({"_molar": molar, "_wide": wide})
    q, point, span = F.col("qualifier_normalized"), F.col("_molar"), F.col("_wide")
    # Bounds turn round on the logarithmic scale.
    upper = q.isin("eq", "approx") & ~(log & (q == "approx")) | q.isin("lt", "le") & ~log | q.isin("gt", "ge") & log
    lower = q.isin("eq", "approx") & ~(log & (q == "approx")) | q.isin("gt", "ge") & ~log | q.isin("lt", "le") & log
    closed = ~q.isin("lt", "gt")
    status = F.when(span.isNotNull() & log, "normalized_log_molar_range").when(span.isNotNull(), "normalized_concentration_range").otherwise(F.col("_status"))
    df = df.withColumns(
        {
            "value_molar": F.when(span.isNotNull(), (span["low"] + span["high"]) / 2).otherwise(point),
            "value_lower_molar": F.when(span.isNotNull(), span["low"]).when(lower, point),
            "value_upper_molar": F.when(span.isNotNull(), span["high"]).when(upper, point),
            "value_lower_inclusive": F.when(span.isNotNull(), True).when(lower & point.isNotNull(), closed),
            "value_upper_inclusive": F.when(span.isNotNull(), True).when(upper & point.isNotNull(), closed),
            "normalization_status": status,
            "has_numeric_value": number.isNotNull() | F.col("_given_molar").isNotNull(),
        }
    )
    supported = F.coalesce(F.col("endpoint_type").isin(*LABELLED_TYPES), F.lit(False))
    reason = (
        F.when(~supported, "unsupported_or_unspecified_endpoint_type")
        .when(~F.col("normalization_status").isin(*NORMALIZED), F.col("normalization_status"))
        .when(q.isin("approx", "unknown"), "unsupported_or_approximate_qualifier")
        .when(F.col("value_lower_molar").isNull() & F.col("value_upper_molar").isNull(), "missing_comparable_molar_interval")
        .otherwise("")
    )
    df = df.withColumns({"negative_log10_molar": -F.log10("value_molar"), "threshold_label_exclusion_reason": reason})
    return df.withColumns(
        {
            "potency_value": F.when(F.col("potency_scale_name").isNotNull(), F.col("negative_log10_molar")),
            "threshold_label_eligible": F.col("threshold_label_exclusion_reason") == "",
        }
    ).drop("_given_molar", "_status", "_molar", "_wide", "_value", "value_range", *TERMS)


def _with_facts(df: DataFrame, threshold_um: float | None) -> DataFrame:
    """What the label rules ask of a measurement, as columns, so that each is computed once."""
    declared = F.col("_declared")
    low, high = F.col("value_lower_molar"), F.col("value_upper_molar")
    tau = (threshold_um or 0.0) / 1e6
    # Products of a value and a unit are off by a few units in the last place: 10 uM, 10000 nM and the threshold are one number.
    close = 1e-12 * tau
    no = lambda c: F.coalesce(c, F.lit(False))
    df = df.withColumn("_declared", label_token("outcome_label_normalized"))
    df = df.withColumns(
        {
            "_active": declared.isin("active", "hit", "positive"),
            "_inactive": declared.isin("inactive", "negative", "no_activity", "not_active"),
            "_unclear": declared.isin("inconclusive", "indeterminate", "ambiguous", "unspecified", "unknown"),
            "_numeric": no(F.col("has_numeric_value")),
            "_use": no(F.col("has_numeric_value") & F.col("endpoint_type").isin(*LABELLED_TYPES)),
        }
    )
    return df.withColumns(
        {
            "_under": F.col("_use") & no(high <= tau + close),
            "_above": F.col("_use") & no((low > tau + close) | (low >= tau - close) & ~F.col("value_lower_inclusive")),
        }
    )


def _label_decision(threshold_um: float | None, weak_is_negative: bool, stored: Column | None = None) -> Column:
    """The label of a measurement with its facts, as a struct of label, reason, basis and reliability.

    A measurement is positive only if its whole interval is at or below the threshold, negative only if it is all
    above and weak activity counts as negative. Declared outcomes that contradict abstain; so do numbers without a
    threshold. A ``stored`` label is used again only without a threshold.
    """
    active, inactive, unclear, numeric = (F.col(c) for c in ("_active", "_inactive", "_unclear", "_numeric"))
    low, high, q = F.col("value_lower_molar"), F.col("value_upper_molar"), F.col("qualifier_normalized")

    rules: list[tuple[Column, int | None, str, str, str]] = []
    add = lambda when, label, *rest: rules.append((when, label, *rest))
    if threshold_um is None and stored is not None:
        text = label_token(stored)
        add(text.isin("1", "1.0", "true", "active", "positive", "curated_active"), 1, "reused_materialized_label", "materialized_policy_output", "policy_reused")
        add(text.isin("0", "0.0", "false", "inactive", "negative", "inactive_or_weak", "curated_inactive"), 0, "reused_materialized_label", "materialized_policy_output", "policy_reused")
        add(text.isin("ambiguous", "ambiguous_or_unlabeled", "unknown", "unlabeled", "curated_unlabeled"), None, "reused_materialized_abstention", "materialized_policy_output", "insufficient")
    add(unclear, None, "explicit_outcome_is_ambiguous_or_conflicting", "source_activity_outcome", "conflicting")
    if threshold_um is None:
        add(inactive, 0, "source_declared_inactive", "source_activity_outcome", "source_asserted")
        add(active, 1, "source_declared_active", "source_activity_outcome", "source_asserted")
        add(numeric, None, "numeric_endpoint_requires_a_declared_activity_threshold", "numeric_endpoint", "insufficient")
    elif not 0 < threshold_um < float("inf"):
        add(F.lit(True), None, "invalid_nonpositive_activity_threshold", "configuration", "invalid_policy")
    else:
        use, under, above = F.col("_use"), F.col("_under"), F.col("_above")
        finite = lambda x: F.coalesce((x > 0) & (x < float("inf")), F.lit(True))
        add(use & ~(finite(low) & finite(high)), None, "invalid_nonpositive_or_nonfinite_interval", "numeric_endpoint", "invalid_measurement")
        add(use & q.isin("approx", "unknown"), None, "approximate_or_unknown_qualifier_has_no_defensible_interval", "numeric_endpoint", "insufficient")
        add(use & low.isNull() & high.isNull(), None, "numeric_endpoint_has_no_convertible_molar_interval", "numeric_endpoint", "insufficient")
        add(under & inactive, None, "numeric_active_conflicts_with_source_inactive", "numeric_and_source_evidence", "conflicting")
        add(under & active, 1, "complete_interval_at_or_below_threshold", "numeric_endpoint_threshold", "concordant_source_and_threshold")
        add(under, 1, "complete_interval_at_or_below_threshold", "numeric_endpoint_threshold", "threshold_supported")
        if weak_is_negative:
            add(above & active, None, "numeric_weak_conflicts_with_source_active", "numeric_and_source_evidence", "conflicting")
            add(above & inactive, 0, "complete_interval_strictly_above_threshold", "numeric_endpoint_threshold", "concordant_source_and_threshold")
            add(above, 0, "complete_interval_strictly_above_threshold", "numeric_endpoint_threshold", "threshold_supported")
        else:
            add(above, None, "weak_numeric_activity_not_configured_as_negative", "numeric_endpoint_threshold", "policy_abstention")
        add(use, None, "measurement_interval_crosses_activity_threshold", "numeric_endpoint_threshold", "insufficient")
        add(numeric & inactive, 0, "unsupported_numeric_type_but_source_declared_inactive", "source_activity_outcome", "source_asserted")
        add(numeric & active, 1, "unsupported_numeric_type_but_source_declared_active", "source_activity_outcome", "source_asserted")
        add(numeric, None, "endpoint_type_not_eligible_for_threshold_labeling", "numeric_endpoint", "insufficient")
        add(inactive, 0, "source_declared_inactive_without_comparable_numeric_endpoint", "source_activity_outcome", "source_asserted")
        add(active, 1, "source_declared_active_without_comparable_numeric_endpoint", "source_activity_outcome", "source_asserted")
    add(F.lit(True), None, "no_supported_activity_evidence", "none", "insufficient")

    def outcome(label, reason, basis, reliability):
        return F.struct(F.lit(label).cast("int").alias("label"), F.lit(reason).alias("reason"), F.lit(basis).alias("basis"), F.lit(reliability).alias("reliability"))

    chain = F.when(rules[0][0], outcome(*rules[0][1:]))
    for when, *rest in rules[1:]:
        chain = chain.when(when, outcome(*rest))
    return chain


def with_label(df: DataFrame, threshold_um: float | None = 10.0, weak_is_negative: bool = True, stored: str | None = None) -> DataFrame:
    """Add label (1, 0, null), label_reason, label_basis and label_reliability to normalised measurements."""
    facts = _with_facts(df, threshold_um)
    decided = facts.withColumn("_decision", _label_decision(threshold_um, weak_is_negative, F.col(stored) if stored else None))
    return decided.withColumns({"label": F.col("_decision.label"), "label_reason": F.col("_decision.reason"), "label_basis": F.col("_decision.basis"), "label_reliability": F.col("_decision.reliability")}).drop("_decision", *(c for c in facts.columns if c not in df.columns))


def assertion(positive: Column, negative: Column, unclear: Column) -> Column:
    """A pair's assertion and its confidence from counts of measurements."""
    total = F.greatest(F.lit(1), positive + negative + unclear)
    case = lambda name, n: F.struct(F.lit(name).alias("assertion"), (n / total).alias("confidence"))
    return (
        F.when((positive > 0) & (negative > 0), case("curated_conflicting", F.greatest(positive, negative)))
        .when(positive > 0, case("curated_active", positive))
        .when(negative > 0, case("curated_inactive", negative))
        .otherwise(case("curated_unlabeled", unclear))
    )
