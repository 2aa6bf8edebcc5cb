"""The queries of this folder, and the same in DuckDB SQL where SQL can express them."""

from blotter.llm import (
    chunk_dedup,
    exact_dedup,
    hard_negatives,
    language_id,
    lexical_search,
    minhash,
    mixing,
    packing,
    secret_scan,
    simhash,
    spotsigs,
    toxicity,
    warc_fixity,
)

QUERIES = {
    "op1_spotsigs": spotsigs.op1_spotsigs,
    "op2_language_id": language_id.op2_language_id,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_simhash": simhash.op4_simhash,
    "op5_chunk_dedup": chunk_dedup.op5_chunk_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_packing": packing.op8_packing,
    "op9_secret_scan": secret_scan.op9_secret_scan,
    "op10_warc_fixity": warc_fixity.op10_warc_fixity,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_minhash": minhash.op13_minhash,
}

#: Learned scores, the tokenizer, the gear hash and XXH64 are beyond SQL, as is reachability over all
#: fingerprints; tests hold those queries against plain Python.
ORACLES = {
    "op1_spotsigs": spotsigs.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op10_warc_fixity": warc_fixity.ORACLE,
    "op11_lexical_search": lexical_search.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_minhash": minhash.ORACLE,
}
