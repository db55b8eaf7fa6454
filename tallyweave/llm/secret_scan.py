"""Secrets in texts, found through a trigram index.

The trigrams that any text with a match must hold are derived from each rule's expression. Every
block of texts gets an inverted index of these trigrams; a rule's Boolean query intersects and
unites postings, and only the texts that are left are searched by the expression itself. A rule
without mandatory trigrams searches every text. Blocks are slices of a task's rows, so nothing
is shuffled, no posting list is longer than its block, and a lost task is done again alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import text_bytes, text_slices
from .trigrams import EVERY_TEXT, Postings, trigram_query, trigrams_of


class Rule(NamedTuple):
    """Non-overlapping matches of ``pattern``, leftmost first, whose ``group`` has ``least``
    characters or more. A match that is too short is dropped and what it covers stays covered."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


#: The rules that the query is defined by. A run that is long enough is found from
#: its start, so "16 or more" stands for "all runs, short ones dropped".
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)

#: Public formats of keys and tokens.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----"),
    Rule("code_host", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("maps", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("url_login", r"\b(?:https?|ftp|postgres|mysql|mongodb|redis|amqp)://[^\s/:@]{1,64}:[^\s/:@]{3,64}@"),
)

RULES = BASE_RULES + MORE_RULES

_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


class _Scanner:
    def __init__(self, rules: Iterable[Rule]):
        self.rules = [(rule, re.compile(rule.pattern, re.ASCII)) for rule in rules]
        self.queries = [trigram_query(rule.pattern, re.ASCII) for rule, _ in self.rules]
        self.wanted = set().union(*map(trigrams_of, self.queries))

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """``start, number of the rule, end`` of each text, ascending."""
        postings = Postings(*text_bytes(texts), self.wanted)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        known: dict[int, str] = {}
        for number, ((rule, expression), query) in enumerate(zip(self.rules, self.queries)):
            for i in postings.texts_of(query).tolist():
                if i not in known:
                    known[i] = texts[i].as_py() or ""
                for match in expression.finditer(known[i]):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found[i].append((match.start(), number, match.end()))
        return [sorted(x) for x in found]


def full_scans(rules: Iterable[Rule] = RULES) -> list[str]:
    """Kinds whose expressions have no mandatory trigram, so that every text is searched."""
    return [rule.kind for rule in rules if trigram_query(rule.pattern, re.ASCII) == EVERY_TEXT]


def scan(docs: DataFrame, id_col: str, text_col: str, rules: Iterable[Rule] = RULES) -> DataFrame:
    """``id, spans`` for each row: ``spans`` holds ``kind, start, end`` in code points, the end
    exclusive, by start and then in the order of the rules. Spans of different rules may overlap.

    A null or empty text has no spans. Rows with equal or null ids are scanned one by one; other
    columns are not read. A text is searched whole, whatever its length.
    """
    scanner = _Scanner(rules)
    names = pa.array([rule.kind for rule, _ in scanner.rules], pa.string())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("spans", T.ArrayType(_SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = scanner.spans(batch.column("text"))
            flat = np.array([x for spans in found for x in spans], np.int64).reshape(-1, 3)
            kinds = names.take(pa.array(flat[:, 1]))
            parts = pa.StructArray.from_arrays([kinds, pa.array(flat[:, 0]), pa.array(flat[:, 2])], ["kind", "start", "end"])
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(ends, parts)], ["id", "spans"])

    return rows.mapInArrow(run, schema)
