"""The registered queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from . import (decontamination, embeddings, htmltext, mixing, periodic, quality, sanitise, sharding, simhash, tokencount, tokenids,
               variants, warc)

QUERIES = {
    "op1_simhash": simhash.query,
    "op2_warc": warc.query,
    "op3_tokencount": tokencount.query,
    "op4_sharding": sharding.query,
    "op5_htmltext": htmltext.query,
    "op6_tokenids": tokenids.query,
    "op7_decontamination": decontamination.query,
    "op8_quality": quality.query,
    "op9_mixing": mixing.query,
    "op10_embeddings": embeddings.query,
    "op11_variants": variants.query,
    "op12_sanitise": sanitise.query,
    "op13_periodic": periodic.query,
}
ORACLE_SQL: dict[str, str] = {
    "op2_warc": warc.SQL,
    "op4_sharding": sharding.SQL,
    "op7_decontamination": decontamination.SQL,
    "op9_mixing": mixing.SQL,
    "op10_embeddings": embeddings.SQL,
    "op11_variants": variants.SQL,
}
