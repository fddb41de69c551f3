"""URL rules as one bit-parallel automaton.

Every rule ``host/path`` stands for its host and all subdomains, and for all paths that start
with its path.  Over the canonical URL (a dot, the host in lower case, the path) that
is the glob ``*.host/path**``: ``*`` stays inside the host, ``**`` takes anything.
All globs are packed side by side into masks of 64-bit words: a state bit per
matched character, a mask per input byte that says which bits move on, and one that says
which bits may wait (Shift-And with self-loops).  One shift and two ANDs per
byte move all rules at once, for a whole batch of URLs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

#: The rules of the query.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
DEFAULT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ANY = np.ones(256, bool)
NOT_SLASH = ANY.copy()
NOT_SLASH[ord("/")] = False


@dataclass(frozen=True)
class Automaton:
    """Masks of shape (256, words); ``start`` (words,); word and bit of each pattern's last state."""

    move: np.ndarray
    wait: np.ndarray
    start: np.ndarray
    last: np.ndarray


def compile_globs(globs: Sequence[str]) -> Automaton:
    """``?`` takes one byte, ``*`` any bytes but a slash, ``**`` any bytes; all else is itself."""
    states: list[tuple[np.ndarray | None, np.ndarray | None]] = []  # what moves on from a state, what waits there
    start, last = [], []
    for glob in globs:
        raw, i = glob.encode(), 0
        start.append(len(states))
        wait = None
        while i < len(raw):
            if raw[i:i + 2] == b"**":
                wait, i = ANY, i + 2
            elif raw[i:i + 1] == b"*":
                wait, i = wait if wait is ANY else NOT_SLASH, i + 1
            else:
                takes = ANY if raw[i:i + 1] == b"?" else np.arange(256) == raw[i]
                states.append((takes, wait))
                wait, i = None, i + 1
        last.append(len(states))
        states.append((None, wait))
    words = max(1, -(-len(states) // 64))
    move, wait_mask = np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64)
    for at, (takes, waits) in enumerate(states):
        bit = np.uint64(1 << at % 64)
        for mask, on in ((move, takes), (wait_mask, waits)):
            if on is not None:
                mask[on, at // 64] |= bit
    begin = np.zeros(words, np.uint64)
    for at in start:
        begin[at // 64] |= np.uint64(1 << at % 64)
    return Automaton(move, wait_mask, begin, np.array(last, np.int64))


def run(automaton: Automaton, texts: Sequence[bytes]) -> np.ndarray:
    """(texts, patterns) booleans: which pattern takes the whole text.

    Texts go by falling length, so those still running are always the first rows;
    the state is one row of words per text, whatever the lengths.
    """
    n = len(texts)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    order = np.argsort(-sizes, kind="stable")
    flat = np.frombuffer(b"".join(texts), np.uint8)
    begins = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    state = np.tile(automaton.start, (n, 1))
    alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if n else 0), side="left")  # texts longer than each place
    for at, live in enumerate(alive):
        byte = flat[begins[:live] + at]
        old = state[:live]
        moved = old & automaton.move[byte]
        carry = moved >> np.uint64(63)
        moved <<= np.uint64(1)
        moved[:, 1:] |= carry[:, :-1]
        state[:live] = moved | (old & automaton.wait[byte])
    hit = (state[:, automaton.last // 64] >> (automaton.last % 64).astype(np.uint64)) & np.uint64(1)
    out = np.empty((n, len(automaton.last)), bool)
    out[order] = hit.astype(bool)
    return out


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lowered; empty for null or without it."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, default: str = DEFAULT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per row of ``pages(page_id, url)``.

    The longest fitting rule decides; none, and so also a null or empty url, gives a null rule and the
    ``default`` verdict.  Rules must be given once each.  Other columns are ignored.
    """
    names = [text for _, text in rules]
    if len(set(names)) != len(names) or any("/" not in n for n in names):
        raise ValueError("rules are host/path, each given once")
    ranked = sorted(range(len(rules)), key=lambda i: (-len(names[i]), names[i]))
    automaton = compile_globs([f"*.{names[i]}**" for i in ranked])

    @F.pandas_udf("int")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            hits = run(automaton, [t.encode() for t in texts])
            first = hits.argmax(axis=1) if hits.shape[1] else np.zeros(len(texts), np.int64)
            none = ~hits.any(axis=1)
            yield pd.Series(np.where(none, -1, first).astype(np.int32))

    at = F.col("_rule") + 2  # -1: none
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), at)
    cut = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    return cut.withColumn("_rule", best(F.concat(F.lit("."), F.col("host"), F.col("path")))).select(
        "page_id", "host", "path", pick([None, *[names[i] for i in ranked]]).alias("rule"),
        pick([default, *[rules[i][0] for i in ranked]]).alias("verdict"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "pages", "page_id", "url"))


def _cases(at: int) -> str:
    fits = []
    for verdict, text in sorted(RULES, key=lambda r: -len(r[1])):
        h, p = text.split("/", 1)
        fits.append(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '/{p}%' THEN '{(text, verdict)[at]}'")
    return " ".join(fits)


ORACLE = f"""WITH u AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, CASE {_cases(0)} END AS rule, CASE {_cases(1)} ELSE '{DEFAULT}' END AS verdict FROM u"""
