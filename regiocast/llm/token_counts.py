"""Token counts per section of a document, by the character spans of its tokens.

A document is encoded once, as a whole, so its tokens are those a model would see; counting
section by section would cut tokens at the borders. Each token has a character span, put together
from a worker's table of the words' spans (see ``tokens``); the spans
are joined to the sections' spans by binary search over the sections' starts. A token that lies
in one section counts there. A token across a border is allocated by ``rule``:

* ``most``: to the section that holds most of its characters, of equal ones the first;
* ``start``: to the section of its first character;
* ``share``: to each section by its share of the characters.

Characters outside all sections belong to section -1. So the counts of a document's sections
always add up to its number of tokens. Rows are worked on by themselves, without a shuffle, in
batches of bounded size.

Null or empty text has no tokens and one empty section 0; very long texts are encoded whole;
repeated rows are counted each; an empty table gives an empty result; other columns are neither
read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from regiocast.llm.tokens import coder

RULES = ("most", "start", "share")
Spans = Callable[[str], np.ndarray]  # text to ascending, disjoint (start, stop) rows


def lines(text: str) -> np.ndarray:
    """Sections of a text: its lines, each with the line feed that ends it."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    stops = np.flatnonzero(points == 10) + 1
    if not len(stops) or stops[-1] < len(points):
        stops = np.append(stops, len(points))
    return np.column_stack([np.append(0, stops[:-1]), stops])


def allocate(tokens: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens per section, outside of all last, and how many tokens lie across a border."""
    counts = np.zeros(len(sections) + 1)
    if not len(tokens):
        return counts, 0
    starts, stops = sections[:, 0], sections[:, 1]
    first = np.searchsorted(starts, tokens[:, 0], side="right") - 1
    inside = (first >= 0) & (tokens[:, 1] <= stops[first])
    counts += np.bincount(first[inside], minlength=len(counts))
    across = np.flatnonzero(~inside)
    crossing = 0
    for t in across.tolist():
        a, b = tokens[t].tolist()
        lo = max(int(np.searchsorted(stops, a, side="right")), 0)
        hi = int(np.searchsorted(starts, b, side="left"))
        shares = [(max(0, min(b, int(stops[s])) - max(a, int(starts[s]))), s)
                  for s in range(lo, hi)]
        outside = (b - a) - sum(n for n, _ in shares)
        shares.append((outside, len(sections)))
        crossing += sum(n > 0 for n, _ in shares) > 1
        if rule == "share" and b > a:
            for n, s in shares:
                counts[s] += n / (b - a)
        elif rule == "start":
            at = lo if lo < hi and starts[lo] <= a < stops[lo] else len(sections)
            counts[at] += 1
        else:
            counts[max(shares, key=lambda x: (x[0], -x[1]))[1]] += 1
    return counts, crossing


def token_counts(docs: DataFrame, tokenizer: str, spans: Spans = lines, rule: str = "most",
                 together: int = 32) -> DataFrame:
    """Per row of ``docs (doc_id, text)`` and section: doc_id, section, start, stop (characters),
    n_tokens, doc_tokens, doc_crossing (tokens of the document across a border).

    ``tokenizer``: path of a byte-level vocabulary file of the tokenizers library.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder("spans", tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, together):
                texts = [t or "" for t in batch.column("text").slice(lo, together).to_pylist()]
                found = code.encode(texts)
                rows, section, start, stop, n, tokens, crossing = ([] for _ in range(7))
                for i, (text, got) in enumerate(zip(texts, found)):
                    cut = spans(text).reshape(-1, 2)
                    counts, across = allocate(got, cut, rule)
                    outside = int(counts[-1] > 0)
                    rows.append(np.full(len(cut) + outside, lo + i))
                    section.append(np.append(np.arange(len(cut)), [-1] * outside))
                    start.append(np.append(cut[:, 0], [0] * outside))
                    stop.append(np.append(cut[:, 1], [0] * outside))
                    n.append(counts[:len(cut) + outside])
                    tokens.append(np.full(len(cut) + outside, len(got)))
                    crossing.append(np.full(len(cut) + outside, across))
                arrays = [batch.column("doc_id").take(pa.array(np.concatenate(rows)))]
                arrays += [pa.array(np.concatenate(x).astype(np.int64))
                           for x in (section, start, stop)]
                arrays.append(pa.array(np.concatenate(n).astype(
                    np.float64 if rule == "share" else np.int64)))
                arrays += [pa.array(np.concatenate(x).astype(np.int64))
                           for x in (tokens, crossing)]
                yield pa.RecordBatch.from_arrays(arrays, [
                    "doc_id", "section", "start", "stop", "n_tokens", "doc_tokens",
                    "doc_crossing"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, section bigint, start bigint, stop bigint, n_tokens "
             f"{'double' if rule == 'share' else 'bigint'}, doc_tokens bigint, "
             "doc_crossing bigint")
