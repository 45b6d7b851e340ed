"""Generated-text columns with retries and status, and reading of model responses.

No model client is shipped: a generator is any picklable ``prompt -> text`` callable.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text of a row whose calls all failed, and states.
FAILED_TEXT = "LLM_FAILED"
SUCCESS = "SUCCESS"
FAILED = "FAILED"
RETRIES = 3


def with_generated(
    df: DataFrame,
    prompt: str,
    out: str,
    generator: Callable[[str], str],
    retries: int = RETRIES,
    failed_text: str | None = FAILED_TEXT,
    pause: Callable[[int], None] | None = None,
    parallel_calls: int | None = None,
) -> DataFrame:
    """Add ``out``, ``generation_status`` and ``attempts``, calling the generator in tasks.

    ``pause(attempt)`` runs before every call after the first (back-off goes there);
    ``failed_text=None`` stores the last error instead of the sentinel;
    ``parallel_calls`` bounds how many tasks call at once.
    """
    if parallel_calls:
        df = df.repartition(parallel_calls)
    added = f"{out} string, generation_status string, attempts int"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow as arrow

        for batch in batches:
            texts, states, tries = [], [], []
            for text in batch.column(prompt).to_pylist():
                answer, state, attempt = None, "FAILED", 0
                while attempt < retries and state == "FAILED":
                    attempt += 1
                    if attempt > 1 and pause is not None:
                        pause(attempt)
                    try:
                        answer, state = generator(text), "SUCCESS"
                    except Exception as error:  # noqa: BLE001 - any failure means retry
                        answer = str(error)
                if state == "FAILED" and failed_text is not None:
                    answer = failed_text
                texts.append(answer)
                states.append(state)
                tries.append(attempt)
            columns = [*batch.columns, arrow.array(texts, "string")]
            columns += [arrow.array(states, "string"), arrow.array(tries, "int32")]
            names = [*batch.schema.names, out, "generation_status", "attempts"]
            yield arrow.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, f"{fields}, {added}")


def response_text(response: Column) -> Column:
    """First text of a chat response held as JSON.

    Choices are read in order; content is a string or a list of typed blocks, of
    which the first ``text`` block counts.  Anything else gives an empty string.
    """
    choices = F.try_variant_get(F.try_parse_json(response), "$.choices", "array<variant>")
    texts = F.transform(choices, _choice_text)
    return F.coalesce(F.get(F.array_compact(texts), F.lit(0)), F.lit(""))


def _choice_text(choice: Column) -> Column:
    content = F.try_variant_get(choice, "$.message.content", "variant")
    kind = F.schema_of_variant(content)
    blocks = F.try_variant_get(content, "$", "array<variant>")
    typed = F.filter(blocks, lambda b: F.try_variant_get(b, "$.type", "string") == "text")
    first_block = F.try_variant_get(F.get(typed, F.lit(0)), "$.text", "string")
    return F.when(kind == "STRING", F.try_variant_get(content, "$", "string")).when(
        kind.startswith("ARRAY"), first_block
    )
