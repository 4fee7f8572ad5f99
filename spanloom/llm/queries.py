"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm.chroma import op7_chroma
from spanloom.llm.conversations import ORACLE_OP12, op12_conversations
from spanloom.llm.decontam import op8_decontam
from spanloom.llm.forest import ORACLE_OP13, op13_minhash
from spanloom.llm.importance import ORACLE_OP11, op11_importance
from spanloom.llm.langid import op4_langid
from spanloom.llm.packing import op9_packing
from spanloom.llm.quality import op10_quality
from spanloom.llm.secrets import op3_secrets
from spanloom.llm.sharding import op6_sharding
from spanloom.llm.simhash import op2_simhash
from spanloom.llm.substrings import op5_substrings
from spanloom.llm.warc import ORACLE_OP1, op1_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_simhash": op2_simhash,
    "op3_secrets": op3_secrets,
    "op4_langid": op4_langid,
    "op5_substrings": op5_substrings,
    "op6_sharding": op6_sharding,
    "op7_chroma": op7_chroma,
    "op8_decontam": op8_decontam,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_importance": op11_importance,
    "op12_conversations": op12_conversations,
    "op13_minhash": op13_minhash,
}

ORACLES: dict[str, str] = {"op1_warc": ORACLE_OP1, "op11_importance": ORACLE_OP11, "op12_conversations": ORACLE_OP12, "op13_minhash": ORACLE_OP13}
