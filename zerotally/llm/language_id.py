"""Language identification by compression: the language whose dictionary makes a text smallest.

Dictionaries and texts are lower-cased first, and dictionaries take short parts of many texts, so that neither capitals
nor a passage that one sampled text happens to hold tip the balance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zerotally.llm.compression import Sizer, build_dictionary, labelled_sample, sampled_parts
from zerotally.llm.frames import binary_text

#: Texts of a language that may be looked at to fill its dictionary.
TEXTS_PER_LANGUAGE = 600
#: Characters of one text that a dictionary may take.
PART = 300
DICTIONARY_BYTES = 56_000
LEVEL = 7
#: A choice is rejected if the second language needs less than this share more.
MARGIN = 0.01
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    names: tuple[str, ...]  # most labelled rows first, then by code point
    dictionaries: tuple[bytes, ...]
    margin: float = MARGIN


def train(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = TEXTS_PER_LANGUAGE) -> LanguageModel:
    """One dictionary per language, from a bounded sample of the labelled rows."""
    sample, counts = labelled_sample(rows, id_col, text_col, F.col(lang_col), per_language)
    parts = sampled_parts(sample, PART)
    names = tuple(sorted(counts, key=lambda name: (-counts[name], name)))
    return LanguageModel(names, tuple(build_dictionary((p.lower() for _, p in parts.get(n, ())), DICTIONARY_BYTES)[0] for n in names))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             held_out: Column | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    lang_pred is the language with the smallest size, ties to the one with more labelled rows. score is the share that
    the choice has if a byte more halves a language's weight. rejected marks narrow margins: the second language needs
    under `margin` more. Null text and text without any letter give `und`, 0.0 and true, as does a model without
    languages. Repeated rows are judged each; whole texts count, however long; an empty table gives no rows; other columns
    of `docs` are not looked at.
    """
    names, dictionaries, margin = model.names, model.dictionaries, model.margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = [Sizer(d, LEVEL) for d in dictionaries]
        for batch in batches:
            langs, scores, rejected = [], [], []
            for raw in binary_text(batch):
                plain = raw.decode("utf-8", "replace").lower()
                text = plain.encode("utf-8", "replace")
                if not each or not any(map(str.isalpha, plain)):
                    langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                sizes = [s.size(text) for s in each]
                best = min(sizes)
                at = sizes.index(best)
                others = sizes[:at] + sizes[at + 1:]
                langs.append(names[at])
                scores.append(1.0 / (1.0 + sum(2.0 ** (best - s) for s in others if s - best < 1000)))
                rejected.append(bool(others) and min(others) - best < margin * max(1, best))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(2), "lang_pred": langs,
                                              "score": scores, "rejected": rejected}, schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                     ("score", pa.float64()), ("rejected", pa.bool_())])
    held = held_out if held_out is not None else F.lit(False)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"))
