"""The queries of this subpackage, as __spark_entry__.py registers them, and their SQL."""

from __future__ import annotations

from meridian.llm import ann, licences, mixing
from meridian.llm.ann import op1_curves
from meridian.llm.bpe import op5_bpe
from meridian.llm.gif import op4_gif
from meridian.llm.licences import op7_licences
from meridian.llm.mixing import op9_mixing
from meridian.llm.quality import op3_quality
from meridian.llm.sharding import op10_hilbert_shards
from meridian.llm.simhash import op2_simhash
from meridian.llm.token_files import op6_token_files
from meridian.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_curves": op1_curves,
    "op2_simhash": op2_simhash,
    "op3_quality": op3_quality,
    "op4_gif": op4_gif,
    "op5_bpe": op5_bpe,
    "op6_token_files": op6_token_files,
    "op7_licences": op7_licences,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_hilbert_shards": op10_hilbert_shards,
}

ORACLES = {
    "op1_curves": ann.ORACLE,
    "op7_licences": licences.ORACLE,
    "op9_mixing": mixing.ORACLE,
}
