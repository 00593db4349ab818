from __future__ import annotations

import pytest

from salesmart.llm import url_digest
from salesmart.llm.queries import URL_RULES
from salesmart.llm.url_digest import Rules, judged, split_url, suffixes, write_rules


def plain(url, rules):
    rest = (url or "").split("://", 1)
    rest = rest[1] if len(rest) == 2 else None
    host = path = ""
    if rest is not None:
        end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        tail = rest[end:]
        path = tail[: min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1])), default=None)
    return host, path, best and best[1] + best[2], best[0] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "https://WWW.Example.COM/en/x?y#z", "http://a.example.com/en/1", "http://example.com",
    "http://example.com?q=/en/", "http://xexample.com/en/1", "http://b.net/es/1", "http://net/es", "http://net/es/", "ftp://x.org/a",
    "a://b://c.com/", "http://É.com/x", "http://www.example.com/english", "http://.com/", "http://com./", "x://y.com/p\nq",
    "http://user@host.com:80/p", "http://" + "a." * 3000 + "net/fr/" + "z" * 5000,
]
MORE = [("block", "host.com:80", "/"), ("block", "y.com", "/p"), ("allow", "y.com", "/"), ("block", "b.net", "/"), ("allow", "net", "/es/1")]


@pytest.mark.parametrize("rules", [[], URL_RULES, MORE, [*URL_RULES, *MORE[:3]]])
def test_equals_plain_rules(spark, rules):
    frame = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string")
    rows = judged(frame, rules).collect()
    assert len(rows) == 2 * len(URLS)
    assert all((r.host, r.path, r.rule, r.verdict) == plain(r.url, rules) for r in rows)
    assert judged(frame.where("false"), rules).collect() == []


def test_colliding_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_digest, "digest", lambda key: len(key) % 3)
    rules = [("block", f"h{i}.com", "/") for i in range(50)] + [("allow", f"g{i}.org", "/x/") for i in range(50)]
    path = str(tmp_path / "rules")
    write_rules(rules, path)
    found = Rules(path).find(["h7.com/", "h99.com/", "g3.org/x/", "g3.org/"])
    assert found == {0: "block", 2: "allow"}


def test_many_rules(tmp_path):
    path = str(tmp_path / "rules")
    lengths, most = write_rules([("block", f"site{i}.com", "/") for i in range(100_000)], path)
    rules = Rules(path)
    assert lengths == [1] and most == 2 and isinstance(rules.keys.base, object)
    keys = [f"site{i}.com/" for i in range(0, 200_000, 7)]
    assert set(rules.find(keys)) == {j for j, i in enumerate(range(0, 200_000, 7)) if i < 100_000}


def test_rules_are_checked(tmp_path):
    path = str(tmp_path / "rules")
    for rules in ([("deny", "a.com", "/")], [("allow", "a.com", "x")], [("allow", "a.com", "/"), ("block", "A.com", "/")]):
        with pytest.raises(ValueError):
            write_rules(rules, path)


def test_parts_of_urls():
    assert split_url("http://A.b?c/d") == ("a.b", "")
    assert suffixes("a.b.c", 2) == ["b.c", "c"] and suffixes("", 2) == [] and suffixes("a.b", 0) == []
