"""SentencePiece encoding and decoding of whole texts."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from postlake.llm.common import map_batches, text_strings

ENCODED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("decoded", T.StringType())])
DIGESTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def encode_texts(docs: DataFrame, model_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, ids, decoded`` of every whole text.

    Null texts count as empty, an empty text has no ids and decodes to itself; a null
    key stays null; repeated rows are encoded each; other columns are ignored.
    """
    def work(keys, texts):
        from postlake.llm.pieces import codec
        coder = codec(model_file)
        ids = [coder.encode(t) for t in text_strings(texts)]
        return {"doc_id": keys, "ids": ids, "decoded": [coder.decode(i) for i in ids]}

    return map_batches(docs.select(docs[key].cast("long"), docs[text].cast("string")), work, ENCODED)


def encode_digests(docs: DataFrame, model_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The same encoding as counts and digests, without carrying the ids through Spark."""
    def work(keys, texts):
        from postlake.llm.pieces import codec
        coder = codec(model_file)
        coded = [coder.coded(t) for t in text_strings(texts)]
        return {"doc_id": keys, "n_tokens": [c[0] for c in coded], "ids_sha256": [sha(c[1]) for c in coded],
                "decoded_sha256": [sha(c[2]) for c in coded]}

    return map_batches(docs.select(docs[key].cast("long"), docs[text].cast("string")), work, DIGESTS)
