"""URL filters: a trie over reversed host labels and path segments, with longest-match precedence.

A rule has a host and a path. It fits a url whose host is the rule's or a subdomain of it and whose path starts with the
rule's. The trie is walked by host labels from the right, then by whole path segments; at each node wait the rules whose
last, unfinished segment may still match as a prefix. Of all rules that fit, the one with the longest spelling wins; of
equally long ones the one with the longer host, then block before allow.

The trie goes to the tasks with the function. Its size is proven before: at most ``MAX_RULES`` rules of at most
``MAX_RULE_CHARS`` characters in sum, else a ValueError.

Nulls: a null url, or one without ``://``, has an empty host and path; only rules with an empty host would fit, and the
default verdict holds. Urls of any length are read whole; repeated rows each get their row; extra columns stay, but those
named host, path, rule or verdict give way to the operator's. An empty table gives no rows, an empty rule list the default
verdict throughout.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000
MAX_RULE_CHARS = 16 << 20
_CUT = re.compile(r"[/?#]")
_PATH_CUT = re.compile(r"[?#]")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = _CUT.search(rest)
    end = cut.start() if cut else len(rest)
    tail = rest[end:]
    cut = _PATH_CUT.search(tail)
    return rest[:end].translate(_LOWER), tail[: cut.start()] if cut else tail


class Trie:
    """Nodes are dicts: labels and ``/segment`` lead to children, ``None`` to the rules that wait with an unfinished segment."""

    def __init__(self, rules: list[UrlRule]):
        if len(rules) > MAX_RULES or sum(len(r.text) for r in rules) > MAX_RULE_CHARS:
            raise ValueError("the rules are too large for a broadcast trie")
        self.root: dict = {}
        for r in rules:
            if r.verdict not in ("allow", "block"):
                raise ValueError(f"verdict {r.verdict!r}")
            node = self.root
            for label in reversed(r.host.translate(_LOWER).split(".")) if r.host else ():
                node = node.setdefault(label, {})
            *whole, last = r.path.split("/")
            for segment in whole:
                node = node.setdefault("/" + segment, {})
            node.setdefault(None, []).append((last, r))
            node[None].sort(key=lambda x: _rank(x[1]), reverse=True)

    def match(self, host: str, path: str) -> UrlRule | None:
        best = None
        segments = path.split("/")
        node = self.root
        labels = host.split(".")[::-1] if host else []
        for k in range(len(labels) + 1):
            best = self._paths(node, segments, best)
            if k == len(labels) or (node := node.get(labels[k])) is None:
                break
        return best

    @staticmethod
    def _paths(node: dict, segments: list[str], best: UrlRule | None) -> UrlRule | None:
        for s in segments:
            for prefix, r in node.get(None, ()):
                if s.startswith(prefix) and (best is None or _rank(r) > _rank(best)):
                    best = r
                    break
            if (node := node.get("/" + s)) is None:
                break
        return best


def _rank(r: UrlRule) -> tuple:
    return len(r.text), len(r.host), r.verdict == "block", r.text


def filter_urls(pages: DataFrame, rules: list[UrlRule], *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict; no shuffle."""
    if default not in ("allow", "block"):
        raise ValueError(f"verdict {default!r}")
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judged(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for u in urls:
            host, path = split_url(u)
            r = trie.value.match(host, path)
            rows.append((host, path, r.text if r else None, r.verdict if r else default))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"], dtype=object)

    made = ("host", "path", "rule", "verdict")
    stay = [c for c in pages.columns if c not in made]
    return pages.select(*stay, judged(F.col(url_col)).alias("_judged")).select(*stay, *[F.col(f"_judged.{c}").alias(c) for c in made])
