"""URL filters: a weighted vocabulary found by Aho-Corasick, and host/path rules.

The vocabulary has strict and soft terms.  One automaton finds all of them in
the URL (A-Z lower-cased); a hit counts only between boundaries: the characters
beside it are no ASCII letter or digit.  One strict hit, or ``soft_min``
distinct soft terms, block a URL.  A rule (host, path) decides before the
vocabulary: it fits its host and all subdomains if the URL's path starts with
the rule's path; of several, the longest (host and path together) wins.

Vocabulary and rules are parameters that every task holds, like code.

Defined results: a null URL, or one without ``://``, has empty host and path and
no rule; the vocabulary is applied to whatever text there is.  Ties between
rules cannot occur: two rules of one length that fit a URL are equal, and of
equal rules the first counts.  Other columns pass through, but the result's own
columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import common

#: Stems of terms that block alone, and of terms of which several must meet; own lists by subject.
STRICT_STEMS = "bdsm camgirl camsex casino escort fetish hentai hookup milf nude nudist porn pornhub porno sexcam sexshop striptease upskirt webcamsex xxx".split()
SOFT_STEMS = (
    "adult amateur babe bet bingo blackjack dating erotic flirt gamble gambling hot jackpot kinky lotto lottery naked poker roulette sex sexy single slot tease wager "  # adults, gambling
    "cheap cialis diet generic herbal levitra loan mortgage payday pharma pharmacy pill prescription refinance rx steroid tablet viagra weightloss xanax "  # pharmacy, credit
    "ad affiliate banner bonus click clickbait coupon crack deal discount farm free freebie giveaway hack keygen lead linkfarm popunder popup prize profit promo "
    "rich scam seo serial spam track tracker traffic warez win winner"  # spam, lures
).split()
#: A term is a stem with one of these endings, so the vocabulary follows from the stems.
ENDINGS = ("", "s", "online", "site")


def vocabulary(stems: Sequence[str], endings: Sequence[str] = ENDINGS) -> tuple[str, ...]:
    return tuple(dict.fromkeys(stem + end for stem in stems for end in endings))


STRICT, SOFT = vocabulary(STRICT_STEMS), vocabulary(SOFT_STEMS)
SOFT_MIN = 2


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def lower(text: str) -> str:
    """A-Z lower-cased, nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def split(url: str) -> tuple[str, str]:
    """Host and path of a URL."""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    rest = rest[:end]
    host, slash, path = rest.partition("/")
    return lower(host), slash + path


class Judge:
    """Rules by host, and the automaton of the vocabulary."""

    def __init__(self, rules: Sequence[Rule], strict: Sequence[str], soft: Sequence[str], soft_min: int) -> None:
        self.by_host: dict[str, list[Rule]] = {}
        for r in rules:
            self.by_host.setdefault(lower(r.host), []).append(r)
        for own in self.by_host.values():
            own.sort(key=lambda r: -len(r.path))
        self.soft_min = soft_min
        self.automaton = ahocorasick.Automaton()
        blocking = set(map(lower, strict))
        for term in dict.fromkeys(map(lower, [*strict, *soft])):
            self.automaton.add_word(term, (term, term in blocking))
        self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        best, end = None, host
        while end:
            for r in self.by_host.get(end, ()):
                if path.startswith(r.path):
                    if best is None or len(r.text) > len(best.text):
                        best = r
                    break
            end = end.partition(".")[2]
        return best

    def hits(self, url: str) -> tuple[int, int]:
        """Distinct strict and soft terms between boundaries."""
        text, strict, soft = lower(url), set(), set()
        if len(self.automaton):
            for last, (term, is_strict) in self.automaton.iter(text):
                begin = last - len(term)
                if not (begin >= 0 and _inner(text[begin])) and not (last + 1 < len(text) and _inner(text[last + 1])):
                    (strict if is_strict else soft).add(term)
        return len(strict), len(soft)

    def __call__(self, url: str) -> tuple[str, str, str | None, str, int, int]:
        host, path = split(url)
        rule, (strict, soft) = self.rule(host, path), self.hits(url)
        verdict = rule.verdict if rule else "block" if strict or soft >= self.soft_min else "allow"
        return host, path, rule.text if rule else None, verdict, strict, soft


def _inner(c: str) -> bool:
    return "a" <= c <= "z" or "0" <= c <= "9"


def judge_urls(pages: DataFrame, url_col: str = "url", rules: Sequence[Rule] = RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_min: int = SOFT_MIN) -> DataFrame:
    """The rows with host, path, rule, verdict, n_strict and n_soft (distinct terms)."""
    common.prepare(pages.sparkSession)
    base = pages.drop("host", "path", "rule", "verdict", "n_strict", "n_soft")
    out = common.extended(base, host="string", path="string", rule="string", verdict="string", n_strict="int", n_soft="int")
    types = [pa.string()] * 4 + [pa.int32()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(rules, strict, soft, soft_min)
        for b in batches:
            rows = [judge(u or "") for u in b.column(b.num_columns - 1).to_pylist()]
            cols = zip(*rows, strict=True) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=[f.name for f in out])

    return base.select("*", F.col(url_col).alias("__td_url")).mapInArrow(run, out)
