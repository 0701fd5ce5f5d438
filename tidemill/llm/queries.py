"""The subpackage's named queries, each with its SQL twin where SQL can say it."""

from tidemill.llm.common import LlmQuery
from tidemill.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from tidemill.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from tidemill.llm.line_dedup import OP3_SQL, op3_line_dedup
from tidemill.llm.packing import op8_packing
from tidemill.llm.pieces import op2_pieces
from tidemill.llm.pii import op9_pii
from tidemill.llm.quality import op10_quality
from tidemill.llm.sharding import OP13_SQL, op13_sharding
from tidemill.llm.simhash import op6_simhash
from tidemill.llm.toxicity import op4_toxicity
from tidemill.llm.url_filter import OP1_SQL, op1_url_filter
from tidemill.llm.vector_codes import OP12_SQL, op12_vector_codes
from tidemill.llm.vector_search import OP5_SQL, op5_vector_search

QUERIES: dict[str, LlmQuery] = {
    "op1_url_filter": LlmQuery(op1_url_filter, OP1_SQL),
    "op2_pieces": LlmQuery(op2_pieces, None),
    "op3_line_dedup": LlmQuery(op3_line_dedup, OP3_SQL),
    "op4_toxicity": LlmQuery(op4_toxicity, None),
    "op5_vector_search": LlmQuery(op5_vector_search, OP5_SQL),
    "op6_simhash": LlmQuery(op6_simhash, None),
    "op7_exact_dedup": LlmQuery(op7_exact_dedup, OP7_SQL),
    "op8_packing": LlmQuery(op8_packing, None),
    "op9_pii": LlmQuery(op9_pii, None),
    "op10_quality": LlmQuery(op10_quality, None),
    "op11_hard_negatives": LlmQuery(op11_hard_negatives, OP11_SQL),
    "op12_vector_codes": LlmQuery(op12_vector_codes, OP12_SQL),
    "op13_sharding": LlmQuery(op13_sharding, OP13_SQL),
}
