import math
import re

import numpy as np

from tickloom.llm import urls
from tickloom.llm.queries import RULES, op3_url_filter, table

SF = "/root/testdata/sf0.01"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def rule_of(host, path, rules=RULES):
    fits = [
        r for r, _ in rules
        if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])
    ]
    return max(fits, key=len, default=None)


def symbols(text):
    return [0, 0, 0, *(int(urls.SYMBOL[b]) for b in text.encode()), 1]


class Model:
    """Witten-Bell smoothing by dictionaries, one context at a time."""

    def __init__(self, texts):
        self.n = {}
        for t in texts:
            s = symbols(t)
            for i in range(3, len(s)):
                for k in range(4):
                    own = self.n.setdefault(tuple(s[i - k : i]), {})
                    own[s[i]] = own.get(s[i], 0) + 1

    def p(self, context, c):
        lower = self.p(context[1:], c) if context else 1 / urls.SYMBOLS
        own = self.n.get(context)
        if not own:
            return lower
        return (own.get(c, 0) + len(own) * lower) / (sum(own.values()) + len(own))


def test_query_equals_brute_force(spark):
    pages = table(spark, SF, "pages").select("page_id", "url").collect()
    rows = {r.page_id: r for r in op3_url_filter(spark, SF).collect()}
    assert len(rows) == len(pages)
    verdicts, sides = dict(RULES), {"allow": [], "block": []}
    for p in pages:
        host, path = split(p.url)
        rule = rule_of(host, path)
        assert (rows[p.page_id].host, rows[p.page_id].path, rows[p.page_id].rule) == (host, path, rule)
        if rule:
            sides[verdicts[rule]].append(host + path)
            assert rows[p.page_id].verdict == verdicts[rule]
    good, bad = Model(sides["allow"]), Model(sides["block"])
    for p in pages[:60]:
        s = symbols("".join(split(p.url)))
        score = np.mean([
            math.log(good.p(tuple(s[i - 3 : i]), s[i]) / bad.p(tuple(s[i - 3 : i]), s[i])) for i in range(3, len(s))
        ])
        assert abs(rows[p.page_id].score - score) < 1e-4
    free = [r for r in rows.values() if r.rule is None]
    by_score = sorted(free, key=lambda r: r.score)
    assert [r.verdict for r in by_score] == sorted((r.verdict for r in free), reverse=True)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://WWW.Example.COM/en/x?y#z"), (5, "http://example.com/en/"),
        (6, "x://com"), (7, "x://com/"), (8, "x://a.net/es/" + "q" * 100_000), (9, "x://é.org/ü?://net/es/"),
        (9, "x://é.org/ü?://net/es/"), (11, "a://b://c.com/d"), (12, "x://notnet/es/"), (13, "x://u@h.com:80/\n/p"),
    ]
    df = spark.createDataFrame([(*r, "a") for r in rows], "page_id long, url string, host string")
    got = sorted(urls.judge(df, RULES).collect(), key=lambda r: r.page_id)
    assert [(r.page_id, r.host, r.path, r.rule) for r in got] == [
        (i, *split(u), rule_of(*split(u))) for i, u in rows
    ]
    assert all(r.verdict in ("allow", "block") and math.isfinite(r.score) for r in got)
    assert urls.judge(df.limit(0), RULES).count() == 0
    assert urls.judge(df, []).count() == len(rows)
