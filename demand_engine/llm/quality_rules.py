"""Quality rules, line first.

Every line is judged by punctuation, navigation and boilerplate rules;
failing lines are removed, and a document that loses too much of its text,
or fails the base rules on the whole text, is rejected. One pass over the
documents: no shuffle, no state beyond one piece of a batch.

Cases: a null text counts as empty and fails (no words); lines without a
word are never judged; repeated rows are judged one by one; an empty table
gives no rows; extra columns are passed through or ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textops as tx

SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B))
_WHITE = b" \t\n\x0b\x0c\r"
_MARKS = b"#*$%&|<>@^~_=+{}[]\\`"
_SEPARATORS = re.compile(rb"(?:^|(?<=[ \t]))(?:[|>\-]|\xc2\xbb|\xe2\x80\xba|\xe2\x80\xa2|\xc2\xb7)(?=[ \t]|$)")
_BOILERPLATE = re.compile(
    rb"all rights reserved|cookie policy|(?:we|site) uses? cookies|privacy policy|terms (?:of|and) (?:use|service|conditions)|"
    rb"enable javascript|lorem ipsum|click here|subscribe (?:now|to our)|sign (?:up|in) |log ?in to|powered by|skip to (?:main )?content|"
    rb"read more\b|share (?:this|on) |follow us|back to top"
)
_TERMINAL = re.compile(rb"(?:[.!?:;]|\xe2\x80\xa6|\xe3\x80\x82|\xef\xbc\x81|\xef\xbc\x9f)(?:[\"')\]]|\xe2\x80\x9d|\xc2\xbb)*$")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules. Shares are of the bytes in a line's words."""

    min_words: int = 50
    max_repeat_pct: int = 50
    max_mark_share: float = 0.15
    max_shouted_share: float = 0.6
    min_shouted_letters: int = 20
    max_cries_per_word: float = 0.34
    min_cries: int = 4
    min_nav_separators: int = 2
    nav_words_per_separator: int = 3
    max_boilerplate_words: int = 20
    min_unpunctuated_words: int = 3
    max_lost_share: float = 0.5


def line_fails(line: bytes, rules: Rules) -> str | None:
    """The first rule that a line with at least one word fails."""
    n_bytes = len(line.translate(None, _WHITE))
    n_words = len(line.split())
    if len(line) - len(line.translate(None, _MARKS)) > rules.max_mark_share * n_bytes and n_words > 0 and b"|" not in line:
        return "punctuation"
    seps = len(_SEPARATORS.findall(line)) if (b"|" in line or b">" in line or b"\xc2" in line or b"\xe2" in line or b" - " in line) else 0
    if seps >= rules.min_nav_separators and n_words - seps <= rules.nav_words_per_separator * (seps + 1):
        return "navigation"
    if len(line) - len(line.translate(None, _MARKS)) > rules.max_mark_share * n_bytes:
        return "punctuation"
    cries = line.count(b"!") + line.count(b"?")
    if cries >= rules.min_cries and cries > rules.max_cries_per_word * n_words:
        return "punctuation"
    upper = len(line) - len(line.translate(None, _UPPER))
    if upper >= rules.min_shouted_letters and upper > rules.max_shouted_share * (len(line) - len(line.translate(None, _LETTERS))):
        return "punctuation"
    if n_words < rules.min_unpunctuated_words and not _TERMINAL.search(line.rstrip(_WHITE)):
        return "punctuation"
    if n_words <= rules.max_boilerplate_words and _BOILERPLATE.search(line.lower()):
        return "boilerplate"
    return None


def clean_text(text: bytes, rules: Rules) -> tuple[bytes, int, int, int, dict[str, int]]:
    """The text without failing lines; bytes in words before and after;
    lines with a word that equal an earlier line; failures by rule."""
    kept, seen, dups, fails, lost = [], set(), 0, {}, 0
    verdicts: dict[bytes, str | None] = {}
    total = len(text.translate(None, _WHITE))
    for line in text.split(b"\n"):
        if not line.strip(_WHITE):
            kept.append(line)
            continue
        if line in seen:
            dups += 1
        else:
            seen.add(line)
            verdicts[line] = line_fails(line, rules)
        why = verdicts[line]
        if why is None:
            kept.append(line)
        else:
            fails[why] = fails.get(why, 0) + 1
            lost += len(line.translate(None, _WHITE))
    return (b"\n".join(kept) if fails else text), total, total - lost, dups, fails


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    _, pair = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)
    _, tri, count = np.unique(pair[:-1] * (int(ids.max()) + 1) + ids[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(count[tri] > 1)
    if not len(at):
        return 0
    hit = np.zeros(n, bool)
    hit[at] = hit[at + 1] = hit[at + 2] = True
    return int(hit.sum())


def _judge(batch: pa.RecordBatch, text: str, rules: Rules) -> dict[str, list | np.ndarray]:
    buf, off = tx.text_bytes(batch.column(text))
    starts, ends, at = tx.tokens(buf, off, tx.SPACED)
    ids, _ = tx.word_ids(buf, starts, ends)
    chars = tx.segment_sums(((buf & 0xC0) != 0x80) & tx.SPACED[buf], off)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    n_words = np.diff(at)
    raw = buf.tobytes()
    repeat, cleaned, total, left, dups, fails = [], [], [], [], [], []
    for i in range(batch.num_rows):
        own = ids[at[i] : at[i + 1]]
        repeat.append(repeated_words(np.unique(own, return_inverse=True)[1] if len(own) > 3 else own))
        out = clean_text(raw[off[i] : off[i + 1]], rules)
        for into, x in zip((cleaned, total, left, dups, fails), out, strict=True):
            into.append(x)
    repeat = np.array(repeat, np.int64)
    failed = (n_words < rules.min_words) | (100 * repeat > rules.max_repeat_pct * n_words)
    kept = ~failed & (np.array(total) - np.array(left) <= rules.max_lost_share * np.array(total))
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": tx.segment_sums(symbol[buf], off), "n_dup_lines": np.array(dups, np.int64),
        "n_repeat_words": repeat, "base_failed": failed, "kept": kept,
        "lost_bytes": np.array(total, np.int64) - np.array(left, np.int64),
        **{f"n_{rule}": np.array([f.get(rule, 0) for f in fails], np.int64) for rule in ("punctuation", "navigation", "boilerplate")},
        "cleaned": cleaned,
    }


STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, lost_bytes long, n_punctuation long, n_navigation long, n_boilerplate long"


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules | None = None, with_text: bool = False) -> DataFrame:
    """One row per document: counts, failures by line rule, the verdict and,
    with ``with_text``, the cleaned text."""
    rules = rules or Rules()
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    names = [part.split()[0] for part in STATS.split(", ")] + ["cleaned"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            got = _judge(piece, "text", rules)
            columns = [pa.array(got[x]) if x != "cleaned" else pa.array(got[x], pa.binary()).cast(pa.string()) for x in names]
            yield pa.RecordBatch.from_arrays([piece.column("id"), *columns], ["id", *names])

    schema = f"id {src.schema['id'].dataType.simpleString()}, {STATS}" + ", cleaned string" * with_text
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def clean_documents(docs: DataFrame, text_col: str = "text", rules: Rules | None = None) -> DataFrame:
    """The documents that pass, with their failing lines removed; the
    columns stay as they are (``n_chars``, where present, follows the text)."""
    rules = rules or Rules()
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, text_col):
            got = _judge(piece, text_col, rules)
            text = pa.array(got["cleaned"], pa.binary()).cast(pa.string()).cast(piece.schema.field(text_col).type)
            columns = []
            for name in names:
                if name == text_col:
                    columns.append(text)
                elif name == "n_chars":
                    columns.append(pa.compute.utf8_length(text).cast(piece.schema.field(name).type))
                else:
                    columns.append(piece.column(name))
            yield pa.RecordBatch.from_arrays(columns, schema=piece.schema).filter(pa.array(got["kept"]))

    return docs.mapInArrow(run, docs.schema)
