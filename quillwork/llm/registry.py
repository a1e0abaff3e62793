"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from quillwork.llm import encoding, format_copies, leakage, lookalike, mixing, near_copies, pair_defects, scan_noise, sentences, split


def queries():
    return {
        "p1_found": scan_noise.p1_found,
        "p1_repaired": scan_noise.p1_repaired,
        "p2_found": split.p2_found,
        "p2_pieces": split.p2_pieces,
        "p3_found": lookalike.p3_found,
        "p3_forms": lookalike.p3_forms,
        "p4_found": near_copies.p4_found,
        "p4_classes": near_copies.p4_classes,
        "p5_found": encoding.p5_found,
        "p5_restored": encoding.p5_restored,
        "p6_found": format_copies.p6_found,
        "p6_groups": format_copies.p6_groups,
        "p6_prompt_groups": format_copies.p6_prompt_groups,
        "p7_found": pair_defects.p7_found,
        "p7_counts": pair_defects.p7_counts,
        "p8_found": leakage.p8_found,
        "p8_items": leakage.p8_items,
        "p9_members": mixing.p9_members,
        "p9_shares": mixing.p9_shares,
        "p10_found": sentences.p10_found,
        "p10_sentences": sentences.p10_sentences,
    }


def oracle_sql():
    return {"p2_found": split.P2_FOUND_SQL, "p6_prompt_groups": format_copies.P6_PROMPT_GROUPS_SQL}
