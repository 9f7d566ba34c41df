"""URLs, patterns, robots rules and cron expressions as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_url(url: Column) -> Column:
    """https by default, lower-case host, no default port, fragment or trailing slash, parameters sorted by name; else null."""
    u = F.trim(url)
    u = F.when(F.contains(u, F.lit("://")), u).otherwise(F.concat(F.lit("https://"), u))
    u = F.regexp_replace(u, "#.*$", "")
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(u, r"^[^:]+://(?:[^/?@]*@)?([^/?:]+)", 1))
    port = F.regexp_extract(u, r"^[^:]+://(?:[^/?@]*@)?[^/?:]+:(\d+)", 1)
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^:]+://[^/?]+(/[^?]*)", 1), "/$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    # By name alone and stable: the place decides between equal names.
    pairs = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x, k: F.struct(F.element_at(F.split(x, "="), 1).alias("n"), k.alias("k"), x.alias("x")))
    search = F.array_join(F.transform(F.array_sort(pairs), lambda p: p["x"]), "&")
    good = scheme.isin("http", "https") & (host.rlike(r"\.[a-z0-9-]{2,}$") | (host == "localhost"))
    return F.when(good, F.concat(scheme, F.lit("://"), host, F.when(default, "").otherwise(F.concat(F.lit(":"), port)), path, F.when(search == "", "").otherwise(F.concat(F.lit("?"), search))))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z]+://(?:[^/?@]*@)?([^/?:#]+)", 1))


def matches_pattern(url: Column, pattern: str) -> Column:
    """``*`` all; no star: substring; leading, trailing or one inner star; else a glob. Case does not count."""
    u, p = F.lower(url), pattern.lower()
    if p == "*":
        return F.lit(True)
    if "*" not in p:
        return u.contains(p)
    if p.count("*") == 1:
        head, tail = p.split("*")
        if not head:
            return u.endswith(tail)
        return u.startswith(head) & (u.endswith(tail) if tail else F.lit(True)) & (F.length(u) >= len(head) + len(tail))
    return u.rlike("^" + ".*".join("".join("\\" + c if not c.isalnum() else c for c in part) for part in p.split("*")) + "$")


def is_private_host(host: Column) -> Column:
    """Literal addresses of private, loopback, link-local or reserved ranges, and localhost."""
    return host.rlike(r"^(localhost|.*\.localhost|0\..*|10\..*|127\..*|169\.254\..*|192\.168\..*|172\.(1[6-9]|2[0-9]|3[01])\..*|100\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\..*|\[?(::1|f[cd][0-9a-f]{2}:.*|fe80:.*)\]?)$")


def parse_robots(text: str) -> list[tuple[list[str], list[tuple[int, str, bool]]]]:
    """Groups of agents with their rules (place, pattern, allowed); an empty Disallow allows everything."""
    groups: list[tuple[list[str], list[tuple[int, str, bool]]]] = []
    fresh = False
    for line in text.splitlines():
        name, _, value = line.split("#")[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "user-agent":
            if not fresh:
                groups.append(([], []))
            groups[-1][0].append(value.lower())
            fresh = True
        elif name in ("allow", "disallow") and groups:
            fresh = False
            rules = groups[-1][1]
            rules.append((len(rules), value or "/", name == "allow" or not value))
    return groups


def robots_allows(urls: DataFrame, url: str, robots: str, agent: str) -> DataFrame:
    """``urls`` with ``allowed``: the longest matching pattern wins, the first rule among equals; no match allows."""
    groups = parse_robots(robots)
    own = next((g for g in groups if any(a != "*" and a in agent.lower() for a in g[0])), None) or next((g for g in groups if "*" in g[0]), ([], []))
    path = F.regexp_replace(F.col(url), r"^[A-Za-z]+://[^/?#]*", "")
    path = F.regexp_replace(F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)), "#.*$", "")
    found = []
    for place, pattern, allowed in own[1]:
        ends = pattern.endswith("$")
        body = ".*".join("".join("\\" + c if not c.isalnum() else c for c in part) for part in (pattern[:-1] if ends else pattern).split("*"))
        hit = F.lit(True) if pattern == "/" else path.rlike("^" + body + ("$" if ends else ""))
        found.append(F.when(hit, F.struct(F.lit(len(pattern)).alias("n"), F.lit(-place).alias("o"), F.lit(allowed).alias("a"))))
    best = F.greatest(*found, found[0]) if found else None
    return urls.withColumn("allowed", F.coalesce(best["a"], F.lit(True)) if found else F.lit(True))


def _cron_values(field: str, low: int, high: int) -> list[int]:
    """The numbers that a field names: a list of single numbers, spans or all, each with a step or without; what can't be read names none."""
    out: set[int] = set()
    for item in field.split(","):
        m = re.fullmatch(r"\s*(?:(\*)|(\d+)(?:-(\d+))?)(?:/(\d+))?\s*", item)
        step = int(m[4] or 1) if m else 0
        if not step:
            continue
        first = low if m[1] else int(m[2])
        last = high if m[1] or (m[4] and not m[3]) else int(m[3] or m[2])
        out.update(range(first, last + 1, step))
    return sorted(x for x in out if low <= x <= high)


def cron_matches(expression: str, ts: Column) -> Column:
    """All five fields must match; Sunday is 0."""
    fields = expression.split()
    if len(fields) != 5:
        raise ValueError("a cron expression has five fields")
    values = [(F.minute(ts), 0, 59), (F.hour(ts), 0, 23), (F.dayofmonth(ts), 1, 31), (F.month(ts), 1, 12), (F.dayofweek(ts) - 1, 0, 6)]
    out = F.lit(True)
    for field, (value, low, high) in zip(fields, values):
        out = out & value.isin(_cron_values(field, low, high))
    return out
