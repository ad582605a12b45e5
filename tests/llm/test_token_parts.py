"""How the token store deals rows out."""

from pyspark.sql import functions as F

import public_tokenizers
from strata.llm.queries import END_ID, TOKENIZER
from strata.llm.token_store import token_blocks

from .helpers import docs


def test_a_shared_id_is_split_and_the_order_kept(spark):
    rows = [(None, f"{k * 7919 % 3000:05d} text") for k in range(1000)] + [(k, f"own {k}") for k in range(2000)]
    blocks = token_blocks(docs(spark, rows), public_tokenizers.path(TOKENIZER), END_ID, 400, part_bytes=3000)
    kept = blocks.filter("block >= 0").collect()
    per_part: dict[int, int] = {}
    order = []
    for r in sorted(kept, key=lambda r: (r.part, r.block)):
        per_part[r.part] = per_part.get(r.part, 0) + len(r.doc_ids)
        order += r.doc_ids
    assert order == [None] * 1000 + list(range(2000))
    assert max(per_part.values()) < 500  # of 1,000 rows without an id
    tokens = blocks.filter("block >= 0").select(F.sum(F.size("doc_ids"))).first()[0]
    assert tokens == 3000
