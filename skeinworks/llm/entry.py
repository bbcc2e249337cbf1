"""The queries and oracle SQL of this subpackage, for __spark_entry__."""

from __future__ import annotations

from skeinworks.llm import answer_defects, canonical_dups, contamination, cooccurrence, mixing, near_dups, quota_sample, sentences


def queries() -> dict:
    return {
        "p1_found": near_dups.p1_found,
        "p2_found": quota_sample.p2_found,
        "p2_report": quota_sample.p2_report,
        "p2_sample": quota_sample.p2_sample,
        "p2_sample_checks": quota_sample.p2_sample_checks,
        "p3_found": answer_defects.p3_found,
        "p3_labels": answer_defects.p3_labels,
        "p3_manifest": answer_defects.p3_manifest,
        "p4_found": canonical_dups.p4_found,
        "p4_collapsed": canonical_dups.p4_collapsed,
        "p5_found": cooccurrence.p5_found,
        "p5_lift": cooccurrence.p5_lift,
        "p6_found": contamination.p6_found,
        "p6_leaked_items": contamination.p6_leaked_items,
        "p7_mixture": mixing.p7_mixture,
        "p7_weights": mixing.p7_weights,
        "p7_checks": mixing.p7_checks,
        "p8_found": sentences.p8_found,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": near_dups.P1_SQL,
        "p2_found": quota_sample.P2_SQL,
        "p2_report": quota_sample.P2_REPORT_SQL,
        "p2_sample_checks": quota_sample.P2_SAMPLE_CHECKS_SQL,
        "p4_found": canonical_dups.P4_SQL,
        "p4_collapsed": canonical_dups.P4_COLLAPSED_SQL,
        "p5_found": cooccurrence.P5_SQL,
        "p5_lift": cooccurrence.P5_LIFT_SQL,
        "p6_found": contamination.P6_SQL,
        "p6_leaked_items": contamination.P6_LEAKED_SQL,
        "p7_checks": mixing.P7_CHECKS_SQL,
    }
