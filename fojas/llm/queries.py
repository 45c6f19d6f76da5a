"""Queries of the training-data operators by name, with SQL where SQL can state them."""

from __future__ import annotations

from fojas.llm import canonical, consensus, leakage, names, packing, scanned, subjects, survivor


def queries() -> dict:
    return {
        "p1_found": consensus.p1_found,
        "p1_consensus": consensus.p1_consensus,
        "p1_annotators": consensus.p1_annotators,
        "p2_found": scanned.p2_found,
        "p2_paragraphs": scanned.p2_paragraphs,
        "p3_found": names.p3_found,
        "p3_parties": names.p3_parties,
        "p6_found": survivor.p6_found,
        "p6_survivors": survivor.p6_survivors,
        "p6_held_out": survivor.p6_held_out,
        "p7_found": canonical.p7_found,
        "p7_mapping": canonical.p7_mapping,
        "p8_containers": packing.p8_containers,
        "p8_fill": packing.p8_fill,
        "p9_found": leakage.p9_found,
        "p9_leaks": leakage.p9_leaks,
        "p10_found": subjects.p10_found,
        "p10_subjects": subjects.p10_subjects,
    }


def oracle_sql() -> dict[str, str]:
    return {}
