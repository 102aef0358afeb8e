"""The registered query of each operator, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from . import alignment, debruijn, decontaminate, langid, line_dedup, neardup, packing, quality, secrets, sharding, spotsigs, vector_codes, webtext

QUERIES = {
    "op1_karmarkar_karp": sharding.op1_karmarkar_karp,
    "op2_spotsigs": spotsigs.op2_spotsigs,
    "op3_block_crf": webtext.op3_block_crf,
    "op4_rank_order": langid.op4_rank_order,
    "op5_coordinate_join": neardup.op5_coordinate_join,
    "op6_line_runs": line_dedup.op6_line_runs,
    "op7_large_item_matching": packing.op7_large_item_matching,
    "op8_trigram_secrets": secrets.op8_trigram_secrets,
    "op9_pigeonhole": decontaminate.op9_pigeonhole,
    "op10_debruijn": debruijn.op10_debruijn,
    "op11_cell_memo": vector_codes.op11_cell_memo,
    "op12_factorisation_machine": quality.op12_factorisation_machine,
    "op13_end_dictionaries": alignment.op13_end_dictionaries,
}

ORACLE_SQL = {
    "op5_coordinate_join": neardup.OP5_SQL,
    "op6_line_runs": line_dedup.OP6_SQL,
    "op8_trigram_secrets": secrets.OP8_SQL,
    "op10_debruijn": debruijn.OP10_SQL,
    "op11_cell_memo": vector_codes.OP11_SQL,
}
