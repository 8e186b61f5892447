"""Strings of added tokens get the ids that the tokenizer gives by default."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from loamfold.llm import queries
from loamfold.llm.tokens import token_pieces

from .test_packing import TEXTS

END = "<|endoftext|>"
ODD = [f"hello {END} x", END, END * 3, f"a  {END}  b", f"{END}\n\n{END} c ", f"<|{END}|> <|endoftext|", f"é{END}é", f"<|ENDOFTEXT|> {END}", f"word {END} " * 900]


def test_ids_of_the_default_tokenizer(spark):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = list(enumerate(TEXTS + ODD))
    rows = token_pieces(spark.createDataFrame(docs, "doc_id long, text string"), queries.byte_vocabulary()).orderBy("doc_id", "piece").collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    for doc, text in docs:
        assert got[doc] == [*whole.encode(text, add_special_tokens=False).ids, 0], text
