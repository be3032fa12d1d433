"""The registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from . import (arrow_files, bpe, collocations, embeddings, minhash, mixing, passages, quality, search, spelling,
               substring, toxicity, urls)

QUERIES = {
    "op1_substring": substring.op1_substring,
    "op2_urls": urls.op2_urls,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_quality": quality.op4_quality,
    "op5_minhash": minhash.op5_minhash,
    "op6_mixing": mixing.op6_mixing,
    "op7_bpe": bpe.op7_bpe,
    "op8_arrow_files": arrow_files.op8_arrow_files,
    "op9_search": search.op9_search,
    "op10_embeddings": embeddings.op10_embeddings,
    "op11_collocations": collocations.op11_collocations,
    "op12_passages": passages.op12_passages,
    "op13_spelling": spelling.op13_spelling,
}
ORACLE = {"op2_urls": urls.OP2_SQL, "op6_mixing": mixing.OP6_SQL, "op11_collocations": collocations.OP11_SQL,
          "op13_spelling": spelling.OP13_SQL}
