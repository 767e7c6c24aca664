"""URL filters: pattern rules looked up by their rarest literal token.

A rule is a regular expression over host and path, with tokens (runs of a-z and 0-9) that every
URL it fits must hold whole. How often these tokens occur is counted over all URLs; each rule
is filed under its rarest. A URL's tokens fetch its candidates, and only those run their
expressions. Rules without such a token are candidates for every URL.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from astrolode.llm.common import key_type, lower_ascii

_TOKEN = re.compile("[a-z0-9]+")
BLOCK, ALLOW = "block", "allow"


@dataclass(frozen=True)
class Rule:
    """`site` rules are reported by name and the longest wins; other rules decide the rest."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool = True


def site_rule(verdict: str, site: str) -> Rule:
    """A host with all its subdomains, from a path on: `example.net/en/`."""
    host, slash, rest = site.partition("/")
    path = slash + rest
    # All labels are whole tokens of a URL that fits; of the path, all but an open end.
    closed = path[:path.rfind("/") + 1]
    tokens = tuple(dict.fromkeys(_TOKEN.findall(host.lower()) + _TOKEN.findall(closed.lower())))
    pattern = rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(site, verdict, pattern, tokens)


def word_rule(verdict: str, word: str) -> Rule:
    """Hosts that hold the word as a whole token."""
    pattern = rf"(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?![a-z0-9])"
    return Rule(word, verdict, pattern, (word,), site=False)


def parts(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_ascii(host), path


def _tokens(subject: F.Column) -> F.Column:
    return F.array_distinct(F.split(F.regexp_replace(lower_ascii(subject), "[^a-z0-9]+", " "), " "))


def token_counts(subjects: DataFrame, wanted: Iterable[str]) -> dict[str, int]:
    """How many URLs hold each wanted token; no more rows than the rules have tokens."""
    wanted = sorted(set(wanted))
    if not wanted:
        return {}
    held = F.array_intersect(_tokens(F.col("subject")), F.array(*map(F.lit, wanted)))
    rows = subjects.select(F.explode(held).alias("token")).groupBy("token").count().collect()
    return {r["token"]: r["count"] for r in rows}


def file_rules(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token (ties: the first in order); under '' those without one."""
    filed: dict[str, list[Rule]] = defaultdict(list)
    for rule in rules:
        rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
        filed[rarest].append(rule)
    return dict(filed)


class Judge:
    """Rules ready to run; made once per task."""

    def __init__(self, filed: dict[str, list[Rule]], otherwise: str):
        self._filed = {
            token: [(rule, re.compile(rule.pattern, re.DOTALL)) for rule in rules]
            for token, rules in filed.items()
        }
        self._otherwise = otherwise

    def __call__(self, host: str, path: str) -> tuple[str | None, str]:
        subject = host + path
        fits = []
        for token in {"", *_TOKEN.findall(lower(subject))} & self._filed.keys():
            fits += [rule for rule, pattern in self._filed[token]
                     if pattern.match(subject if rule.site else host)]
        # The longest site rule; a block goes before an allow of the same length.
        order = [(r.site, len(r.name), r.verdict == BLOCK, r.name, r) for r in fits]
        if not order:
            return None, self._otherwise
        rule = max(order, key=lambda o: o[:4])[4]
        return (rule.name if rule.site else None), rule.verdict


def lower(text: str) -> str:
    return text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def judge(pages: DataFrame, rules: Sequence[Rule], otherwise: str = ALLOW) -> DataFrame:
    """`page_id`, `host`, `path`, the `rule` that decided (a site rule, else null), `verdict`.

    A null URL, or one without `://`, has an empty host and path and gets the general verdict.
    Rows never move; repeated rows give repeated results. Extra columns are left out. The rules
    travel with the tasks: their number is the caller's and does not grow with the pages.
    """
    host, path = parts(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    counts = token_counts(
        cut.select(F.concat("host", "path").alias("subject")), (t for r in rules for t in r.tokens))
    filed = file_rules(rules, counts)

    def run(batches):
        decide = Judge(filed, otherwise)
        for batch in batches:
            pairs = zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)
            found = [decide(h, p) for h, p in pairs]
            yield pa.record_batch([
                *batch.columns, pa.array([r for r, _ in found], pa.string()),
                pa.array([v for _, v in found], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"])

    return cut.mapInArrow(
        run, f"page_id {key_type(pages, 'page_id')}, host string, path string, rule string, "
             "verdict string")
