"""The registered queries of this subpackage and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import chosenpath, chunkdedup, collocations, langid, manifest, mixing, nearest, packing, revisits, sharding, simhash, tokencounts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": packing.op1_packing,
    "op2_language_mixture": langid.op2_language_mixture,
    "op3_rendezvous_sharding": sharding.op3_rendezvous_sharding,
    "op4_mixing": mixing.op4_mixing,
    "op5_warc_revisits": revisits.op5_warc_revisits,
    "op6_token_rollup": tokencounts.op6_token_rollup,
    "op7_simhash": simhash.op7_simhash,
    "op8_block_nearest": nearest.op8_block_nearest,
    "op9_chosen_path_join": chosenpath.op9_chosen_path_join,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_merkle_manifest": manifest.op11_merkle_manifest,
    "op12_chunk_recipes": chunkdedup.op12_chunk_recipes,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

SQL: dict[str, str] = {
    "op3_rendezvous_sharding": sharding.OP3_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op5_warc_revisits": revisits.OP5_SQL,
    "op11_merkle_manifest": manifest.OP11_SQL,
    "op12_chunk_recipes": chunkdedup.OP12_SQL,
    "op13_phrase_collocations": collocations.OP13_SQL,
}
