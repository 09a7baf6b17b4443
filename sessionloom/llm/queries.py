"""The subpackage's queries by name: each takes (spark, folder of the tables)."""

from sessionloom.llm import bpe, budget, conversations, credentials, packing, personal, splitting

QUERIES = {
    "p1_found": conversations.p1_found,
    "p1_turns": conversations.p1_turns,
    "p2_found": credentials.p2_found,
    "p2_redacted": credentials.p2_redacted,
    "p4_found": personal.p4_found,
    "p4_sanitised": personal.p4_sanitised,
    "p4_terms": personal.p4_terms,
    "p7_budget": budget.p7_budget,
    "p7_tokens": budget.p7_tokens,
    "p8_ids": bpe.p8_ids,
    "p9_containers": packing.p9_containers,
    "p9_fill": packing.p9_fill,
    "p10_pieces": splitting.p10_pieces,
    "p10_ranges": splitting.p10_ranges,
}
