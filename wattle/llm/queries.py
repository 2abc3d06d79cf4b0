"""The numbered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from .bpe import op11_bpe
from .chat import OP8_SQL, op8_chat
from .decontam import OP2_SQL, op2_decontamination
from .langid import op1_language_id
from .licenses import op10_license_scan
from .merkle import OP12_SQL, op12_merkle_manifest
from .mixing import OP7_SQL, op7_mixing
from .ngram_join import OP3_SQL, op3_ngram_join
from .pii import op4_personal_data
from .syncmers import op5_fingerprints
from .tokens import op9_tokens
from .toxicity import op6_toxicity
from .whitening import op13_whitening

QUERIES = {"op1_language_id": op1_language_id, "op2_decontamination": op2_decontamination, "op3_ngram_join": op3_ngram_join,
           "op4_personal_data": op4_personal_data, "op5_fingerprints": op5_fingerprints, "op6_toxicity": op6_toxicity, "op7_mixing": op7_mixing, "op8_chat": op8_chat,
           "op9_tokens": op9_tokens, "op10_license_scan": op10_license_scan,
           "op11_bpe": op11_bpe, "op12_merkle_manifest": op12_merkle_manifest, "op13_whitening": op13_whitening}
ORACLES = {"op2_decontamination": OP2_SQL, "op3_ngram_join": OP3_SQL, "op7_mixing": OP7_SQL, "op8_chat": OP8_SQL,
           "op12_merkle_manifest": OP12_SQL}
