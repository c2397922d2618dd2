"""Scores and reason ladders, as columns. The formulas stand here once; every model takes them from here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightwire.functions.text import is_blank

# Thresholds, weights, versions and labels that results carry.
FEED_THRESHOLD, POSITIVITY_THRESHOLD, SUITABILITY_THRESHOLD = 65, 65, 60
V2_VERSION, V3_VERSION, RULES_VERSION = "v2_1_guardrailed_tone", "v3_dual_score_shadow", "v1_1_title_rules"
URL_PENALTY = {"broken": 40.0, "redirect_loop": 30.0, "unavailable": 20.0, "timeout": 15.0, "forbidden": 10.0, "unchecked": 5.0}
BAD_URL = ("broken", "redirect_loop", "unavailable")
ADJUSTMENT = {"strong": 8.0, "good": 4.0, "weak": -4.0, "poor": -8.0}
MAX_ADJUSTMENT = 8.0


def clamp(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def base_score(tone: Column) -> Column:
    """Tone -10 to 10 on a scale of 0 to 100."""
    return F.round(100 * clamp(F.try_divide(tone + 10.0, F.lit(20.0)), 0.0, 1.0), 2)


def bonus(tokens: Column, phrases: Column) -> Column:
    return F.least(F.lit(10.0), 2.0 * tokens + 5.0 * phrases)


def unresolved_soft(soft: Column, allow: Column) -> Column:
    return (soft > 0) & (allow == 0)


def v2_score(base: Column, tokens: Column, phrases: Column, soft: Column, allow: Column) -> Column:
    return F.round(clamp(base + bonus(tokens, phrases) - F.when(unresolved_soft(soft, allow), 12.0).otherwise(0.0)), 2)


def ladder(*steps: tuple[Column, str]) -> Column:
    """The label of the first step that holds, else null."""
    out = None
    for holds, label in steps:
        out = F.when(holds, label) if out is None else out.when(holds, label)
    return out


def v2_reason() -> Column:
    """Over columns title, url, hard_deny_hit_count, soft_deny_hit_count, allow_hit_count, happy_factor."""
    c = F.col
    return ladder(
        (is_blank(c("title")), "missing_title"),
        (is_blank(c("url")), "missing_url"),
        (c("hard_deny_hit_count") > 0, "hard_deny_term"),
        (unresolved_soft(c("soft_deny_hit_count"), c("allow_hit_count")), "soft_deny_without_exception"),
        (c("happy_factor") < FEED_THRESHOLD, "below_threshold"),
    )


def v3_reason(gate_only: bool = False) -> Column:
    """gate_only: without the step on positivity."""
    c = F.col
    steps = [
        (~c("has_title"), "missing_title"),
        (~c("has_url"), "missing_url"),
        (~c("has_valid_url"), "malformed_url"),
        (c("hard_deny_hit_count") > 0, "hard_deny_term"),
        (unresolved_soft(c("soft_deny_hit_count"), c("allow_hit_count")), "soft_deny_without_exception"),
        *((c("url_quality_status") == s, f"url_{s}") for s in BAD_URL),
        (c("positivity_score") < POSITIVITY_THRESHOLD, "below_positivity_threshold"),
        (c("suitability_score") < SUITABILITY_THRESHOLD, "low_suitability"),
    ]
    return ladder(*(s for s in steps if not (gate_only and s[1] == "below_positivity_threshold")))


def headline_penalty() -> Column:
    c, points = F.col, lambda holds, n: F.when(holds, n).otherwise(0.0)
    return F.least(
        F.lit(20.0),
        points(c("has_punctuation_bait"), 6.0)
        + points((c("title_token_count") >= 5) & (c("uppercase_ratio") >= 0.4), 6.0)
        + points(c("has_gallery_bait"), 8.0)
        + points(c("template_repeat_count") >= 5, 6.0),
    )


def url_penalty(status: Column) -> Column:
    """A status that isn't listed costs nothing."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in URL_PENALTY.items() for x in kv)), F.coalesce(status, F.lit("unchecked"))), F.lit(0.0))


def bounded_adjustment(c: Column) -> Column:
    return clamp(c, -MAX_ADJUSTMENT, MAX_ADJUSTMENT)


def positivity(base: Column, constructive: Column, upstream: Column) -> Column:
    return F.round(clamp(base + constructive + upstream), 2)


def suitability() -> Column:
    c, cost = F.col, lambda holds, n: F.when(holds, n).otherwise(0.0)
    return F.round(
        clamp(
            100.0
            - c("headline_shape_penalty")
            - c("url_quality_penalty")
            - cost(~c("has_title"), 100.0)
            - cost(~c("has_valid_url"), 100.0)
            - cost(c("hard_deny_hit_count") > 0, 100.0)
            - cost(unresolved_soft(c("soft_deny_hit_count"), c("allow_hit_count")), 25.0)
            + bounded_adjustment(c("source_quality_adjustment"))
        ),
        2,
    )


def v3_score(positive: Column, suitable: Column) -> Column:
    return F.round(clamp(0.7 * positive + 0.3 * suitable), 2)


def quality_tier() -> Column:
    """Over the rounded rates of a source; the steps are tried in order."""
    c = F.col
    rows, eligible, bad, copies = c("sample_row_count"), c("eligible_rate"), c("invalid_or_unavailable_url_rate"), c("duplicate_or_near_duplicate_rate")
    return F.coalesce(
        ladder(
            (rows < 10, "mixed"),
            ((eligible >= 0.60) & (bad < 0.02) & (copies < 0.15), "strong"),
            ((eligible >= 0.45) & (bad < 0.05) & (copies < 0.25), "good"),
            ((bad >= 0.15) | (eligible < 0.20) | (copies >= 0.50), "poor"),
            ((bad >= 0.08) | (eligible < 0.35) | (copies >= 0.35), "weak"),
        ),
        F.lit("mixed"),
    )


def tier_adjustment(tier: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in ADJUSTMENT.items() for x in kv)), tier), F.lit(0.0))
