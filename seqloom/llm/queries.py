"""Queries of the operators in this part, and their SQL where SQL can express them."""

from . import canonical, components, langid, packing, spans, tokens

LLM = {
    "p2_found": spans.p2_found,
    "p2_shares": spans.p2_shares,
    "p2_passages": spans.p2_passages,
    "p2_occurrences": spans.p2_occurrences,
    "p3_found": components.p3_found,
    "p3_sizes": components.p3_sizes,
    "p4_found": canonical.p4_found,
    "p4_counts": canonical.p4_counts,
    "p7_ids": tokens.p7_ids,
    "p7_decoded": tokens.p7_decoded,
    "p7_chunked": tokens.p7_chunked,
    "p8_packed": packing.p8_packed,
    "p8_fill": packing.p8_fill,
    "p8_checked": packing.p8_checked,
    "p9_found": langid.p9_found,
    "p9_passages": langid.p9_passages,
}
LLM_SQL = {**spans.SQL, **components.SQL, **canonical.SQL, **tokens.SQL, **packing.SQL}
