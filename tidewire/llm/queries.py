"""The operators' queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from tidewire.llm import embedding_dedup, exact_dedup, lattice, license_scan, merkle, mixing, ngram_join, packing, resampling, sharding, toxicity, url_filter, warc_revisits

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_embedding_near_dedup": embedding_dedup.op2_embedding_near_dedup,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_warc_revisits": warc_revisits.op5_warc_revisits,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_vector_shards": sharding.op8_vector_shards,
    "op9_license_scan": license_scan.op9_license_scan,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_lattice_likelihood": lattice.op11_lattice_likelihood,
    "op12_importance_resampling": resampling.op12_importance_resampling,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

SQL = {
    "op2_embedding_near_dedup": embedding_dedup.SQL,
    "op3_mix_sources": mixing.SQL,
    "op4_url_filter": url_filter.SQL,
    "op5_warc_revisits": warc_revisits.SQL,
    "op7_ngram_join": ngram_join.SQL,
    "op10_exact_dedup": exact_dedup.SQL,
    "op12_importance_resampling": resampling.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
