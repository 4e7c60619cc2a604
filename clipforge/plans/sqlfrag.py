"""DuckDB SQL fragments that mirror the column functions, for the oracle statements."""

from __future__ import annotations

from clipforge.functions.text import WS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{WS}+|{WS}+$')}, '', 'g')"


def split_ws(x: str) -> str:
    return f"list_filter(regexp_split_to_array({strip(x)}, {q(WS + '+')}), lambda t: t <> '')"


def clean_text(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '\\|', '', 'g'), {q(WS + '+')}, ' ', 'g'))"


def clean_title(x: str) -> str:
    return f"regexp_replace({clean_text(x)}, {q(f'^-*{WS}*')}, '')"


def unescape(x: str) -> str:
    for ent, ch in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
                    ("&#x27;", "'"), ("&nbsp;", " "), ("&copy;", "\u00a9"),
                    ("&middot;", "\u00b7"), ("&amp;", "&")]:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def h1_title(html: str = "html") -> str:
    raw = f"regexp_replace(regexp_extract({html}, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', '', 'g')"
    return clean_title(unescape(raw))
