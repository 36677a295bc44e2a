"""Verdicts on URLs: host rules, and pattern rules found by their rarest token.

Host rules (verdict, host, path) fit a host and its subdomains if the URL's path starts with theirs; the
longest wins. They are looked up by the host's ends. Where none fits, pattern rules judge: each is indexed
under one token of its literal text, the one that the fewest URLs of the table hold; a URL's tokens fetch
the candidate rules, and only those run their regular expression. A pattern without a whole token runs on
every URL. An allowing match outweighs blocking ones; without a match a URL is allowed.

Patterns: ``*`` is any text, ``^`` a separator or the end, ``||`` at the start the beginning of the host or
of one of its parent domains, ``|`` at either end that end. Letters A-Z count as small ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values.
HOST_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
PATTERN_RULES = (
    ("block", "||adult-"),
    ("block", "||casino."),
    ("block", "||ads."),
    ("block", "||tracker.*/pixel^"),
    ("block", "/banner/*/ad^"),
    ("block", "/wp-login.php|"),
    ("block", "&session_id="),
    ("block", "^logout^"),
    ("block", "*popunder*"),
    ("allow", "||adult-education."),
    ("allow", "/robots.txt|"),
)

_TOKEN = re.compile(r"[a-z0-9]+")
_END = r"\Z"


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def expression(pattern: str, end: str = _END) -> str:
    """The regular expression of a pattern, over the URL in small letters."""
    start, pattern = "", ascii_lower(pattern)
    if pattern.startswith("||"):
        start, pattern = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?", pattern[2:]
    elif pattern.startswith("|"):
        start, pattern = "^", pattern[1:]
    closed = pattern.endswith("|")
    body = pattern[:-1] if closed else pattern
    parts = {"*": "(?s:.*)", "^": rf"(?:[^a-z0-9_.%-]|{end})"}
    return start + "".join(parts.get(c) or re.sub(r"([^a-z0-9\s/&=_:-])", r"\\\1", c) for c in body) + (end if closed else "")


def tokens(pattern: str) -> list[str]:
    """Runs of letters and digits that a match is sure to hold as whole tokens of the URL."""
    text = ascii_lower(pattern)
    opened = text.startswith("|")
    body = text.lstrip("|") if opened else text
    closed = body.endswith("|")
    body = body[:-1] if closed else body
    whole = []
    for m in _TOKEN.finditer(body):
        left = opened if m.start() == 0 else body[m.start() - 1] != "*"
        right = closed if m.end() == len(body) else body[m.end()] != "*"
        if left and right:
            whole.append(m.group())
    return whole


@dataclass(frozen=True)
class Index:
    """Patterns by token, those without one, and host rules by host."""

    by_token: dict[str, list[tuple[str, re.Pattern]]]
    always: list[tuple[str, re.Pattern]]
    by_host: dict[str, list[tuple[str, str, str]]]

    @classmethod
    def of(cls, host_rules, pattern_rules, counts: dict[str, int]) -> Index:
        by_token, always, by_host = {}, [], {}
        for verdict, pattern in pattern_rules:
            rule = (verdict, re.compile(expression(pattern)))
            found = sorted(tokens(pattern), key=lambda t: (counts.get(t, 0), -len(t), t))
            (by_token.setdefault(found[0], []) if found else always).append(rule)
        for verdict, host, path in host_rules:
            by_host.setdefault(host, []).append((path, host + path, verdict))
        return cls(by_token, always, by_host)

    def by_host_rule(self, host: str, path: str) -> tuple[str, str] | None:
        best, at = None, 0
        while self.by_host:
            for start, rule, verdict in self.by_host.get(host[at:], ()):
                if path.startswith(start) and (best is None or len(rule) > len(best[0])):
                    best = rule, verdict
            at = host.find(".", at) + 1
            if not at:
                return best
        return best

    def by_pattern(self, url: str) -> str:
        low, verdict = ascii_lower(url), "allow"
        rules = [r for t in dict.fromkeys(_TOKEN.findall(low)) for r in self.by_token.get(t, ())]
        for says, found in (*rules, *self.always):
            if (says == "allow" or verdict == "allow") and found.search(low):
                if says == "allow":
                    return says
                verdict = says
        return verdict


def host_and_path(url: str | None) -> tuple[str, str]:
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    return ascii_lower(host), re.match(r"[^?#]*", rest[len(host) :]).group()


def token_counts(urls: DataFrame, wanted: set[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens; no more numbers than the rules have tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for url in batch.column(0).to_pylist():
                counts.update(wanted.intersection(_TOKEN.findall(ascii_lower(url or ""))))
        yield pa.RecordBatch.from_pydict({"token": pa.array(counts, pa.string()), "n": pa.array(counts.values(), pa.int64())})

    found = urls.mapInArrow(work, "token string, n long").groupBy("token").agg(F.sum("n")).collect()
    return {token: n for token, n in found}


def judge_urls(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict: one row for every row of ``pages`` (page_id, url).

    Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z made small; path: from there
    up to ``?``, ``#`` or the end. ``rule`` is the host rule that decided, else null. Defined cases: a null URL or
    one without ``://`` has an empty host and path, and no host rule fits it; of equally long rules the first
    wins; repeated rows each give a row; a null id stays null; an empty table gives no rows. Other columns are
    ignored. The rules, not the table, make up what goes to the executors.
    """
    wanted = {t for _, p in pattern_rules for t in tokens(p)}
    counts = token_counts(pages.select("url"), wanted)
    kind = pages.schema["page_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index.of(host_rules, pattern_rules, counts)
        for batch in batches:
            out = []
            for url in batch.column(1).to_pylist():
                host, path = host_and_path(url)
                rule, verdict = index.by_host_rule(host, path) or (None, None)
                out.append((host, path, rule, verdict or index.by_pattern(url or "")))
            columns = zip(*out, strict=True) if out else [[]] * 4
            arrays = [batch.column(0), *(pa.array(list(c), pa.string()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "host", "path", "rule", "verdict"])

    source = pages.select("page_id", F.col("url").cast("string").alias("url"))
    return source.mapInArrow(work, f"page_id {kind}, host string, path string, rule string, verdict string")


def judge_sql(host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> str:
    """What ``judge_urls`` returns, for DuckDB, rule by rule."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = lambda x: f"translate({x}, '{letters}', '{letters.lower()}')"
    text = lambda x: "'" + x.replace("'", "''") + "'"
    fits = lambda host, path: f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
    ordered = sorted(host_rules, key=lambda r: -len(r[1] + r[2]))
    by_rule = "".join(f" WHEN {fits(h, p)} THEN {{}}" for _, h, p in ordered)
    matches = lambda says: " OR ".join(
        f"regexp_matches(low, {text(expression(p, '$'))})" for v, p in pattern_rules if v == says
    )
    return f"""
SELECT page_id, host, path, CASE{by_rule.format(*(text(h + p) for _, h, p in ordered))} END AS rule,
  CASE{by_rule.format(*(text(v) for v, _, _ in ordered))}
    WHEN {matches("allow")} THEN 'allow' WHEN {matches("block")} THEN 'block' ELSE 'allow' END AS verdict
FROM (
  SELECT page_id, {low("coalesce(url, '')")} AS low,
    {low("regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages)"""
