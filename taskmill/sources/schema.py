"""Row types of tasks and question pools."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _A = T.StringType(), T.ArrayType(T.StringType())

TASK_ITEM = T.StructType(
    [
        T.StructField("question_id", _S, False), T.StructField("data_split", _S, False), T.StructField("domain", _S, False),
        T.StructField("question_type", _S, False), T.StructField("question_text", _S, False), T.StructField("choices", _A, False),
        T.StructField("reference_answer", _S, False), T.StructField("reference_answer_index", T.IntegerType(), True),
        T.StructField("reference_aliases", _A, False), T.StructField("metadata", _S, True),
    ]
)
TASK_COLUMNS = TASK_ITEM.fieldNames()

POOL_RECORD = T.StructType(
    [
        *[T.StructField(c, _S, False) for c in ("source_dataset", "source_split", "subject", "question")], T.StructField("choices", _A, False),
        T.StructField("answer", _S, False), T.StructField("answer_index", T.IntegerType(), True), T.StructField("prompt_text", _S, False), T.StructField("meta", _S, False),
    ]
)

# Names of the row contracts and question types.
CONTRACTS = ["task_v1", "task_item_v1", "seed_input_v1", "world_question_v1"]
BENCHMARK_CONTRACT = "world_question_v1"
QUESTION_TYPES = ["multiple_choice", "open_qa"]

# Accepted key names, first present one counts even if it is null.
KEYS = {
    "question_text": ["question_text", "question"],
    "reference_answer": ["reference_answer", "answer", "gold_answer"],
    "reference_answer_index": ["reference_answer_index", "answer_index", "gold_answer_index"],
    "reference_aliases": ["reference_aliases", "answer_aliases", "gold_aliases"],
    "data_split": ["data_split", "split"],
}
