"""Pages of another generator than the one that the extraction is fitted on: nested main texts, and single cases."""

from __future__ import annotations

import random

SYLLABLES = ["ka", "lo", "mi", "ter", "sun", "vel", "or", "ith", "en", "da"]


def words(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(n))


def page(seed: int, plain: bool) -> tuple[str, list[str]]:
    """html and the blocks of its main text; if plain, nothing states a role."""
    r = random.Random(f"second {seed}")
    kept: list[str] = []

    def k(t: str) -> str:
        kept.append(t)
        return t

    def para() -> str:
        return words(r, r.randint(15, 60)) + "."

    def tag(t: str) -> str:
        return "div" if plain else t

    def name(x: str) -> str:
        return "" if plain else f' class="{x}"'

    def links(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(r, r.randint(1, 3))}</a></li>' for i in range(n)) + "</ul>"

    def part(level: int) -> str:
        out = []
        for _ in range(r.randint(1, 4)):
            c = r.choice(["p", "p", "p", "list", "table", "figure", "dl", "quote", "pre", "section"])
            if c == "p":
                out.append(f"<p>{k(para())}</p>")
            elif c == "list":
                g = r.choice(["ul", "ol"])
                out.append(f"<{g}>" + "".join(f"<li>{k(words(r, r.randint(1, 12)))}</li>" for _ in range(r.randint(2, 6))) + f"</{g}>")
            elif c == "table":
                out.append("<table><tbody>" + "".join("<tr>" + "".join(f"<td>{k(words(r, r.randint(1, 3)))}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 5))) + "</tbody></table>")
            elif c == "figure":
                out.append(f"<figure><img src=x.png><figcaption>{k(words(r, r.randint(3, 10)))}</figcaption></figure>")
            elif c == "dl":
                out.append("<dl>" + "".join(f"<dt>{k(words(r, 2))}</dt><dd>{k(words(r, r.randint(2, 15)))}</dd>" for _ in range(r.randint(1, 4))) + "</dl>")
            elif c == "quote":
                out.append(f"<blockquote><p>{k(para())}</p></blockquote>" if r.random() < 0.5 else f"<blockquote>{k(words(r, 6))}</blockquote>")
            elif c == "pre":
                out.append(f"<pre>{k(words(r, r.randint(4, 20)))}</pre>")
            elif level < 2:
                out.append(f"<{tag('section')}><h3>{k(words(r, 3))}</h3>{part(level + 1)}</{tag('section')}>")
        return "".join(out)

    title = f"<h1>{k(words(r, 5))}</h1>"
    inner = title + "".join(f"<{tag('section')}><h2>{k(words(r, 3))}</h2><p>{k(para())}</p>{part(0)}</{tag('section')}>" for _ in range(r.randint(1, 4)))
    body = f"<{tag('header')}{name('site-header')}><div>{words(r, 2)}</div><{tag('nav')}>{links(r.randint(4, 8))}</{tag('nav')}></{tag('header')}>"
    if r.random() < 0.4:
        body += f"<div{name('cookie-bar')}>{words(r, 10)} <button>ok</button></div>"
    body += f"<{tag('main')}><{tag('article')}>{inner}</{tag('article')}>"
    if r.random() < 0.5:
        body += f"<{tag('aside')}{name('sidebar')}><h4>{words(r, 2)}</h4>{links(5)}</{tag('aside')}>"
    body += f"</{tag('main')}>"
    if r.random() < 0.4:
        each = "".join(f"<div{name('comment')}><b>{words(r, 1)}</b><p>{words(r, r.randint(5, 25))}</p></div>" for _ in range(r.randint(2, 5)))
        body += f"<div{name('comments')}><h3>{r.randint(2, 9)} {words(r, 1)}</h3>{each}</div>"
    body += f"<{tag('footer')}><p>&copy; 2024 {words(r, 4)}</p>{links(3)}</{tag('footer')}>"
    return f"<!DOCTYPE html><html><head><title>{words(r, 3)}</title></head><body>{body}</body></html>", kept


def cases() -> list[tuple[str, list[str]]]:
    """Ten articles of two paragraphs and something else, each as an article element and as a plain one, and two texts without block elements."""
    r = random.Random(5)
    a, b = words(r, 20) + ".", words(r, 20) + "."
    menu = "<ul>" + "".join(f'<li><a href="/{k}">{words(r, 1)}</a></li>' for k in range(6)) + "</ul>"
    foot = f"&copy; {words(r, 6)}"
    h1, h2, cap, quote, pre, s1, s2 = (words(r, n) for n in (2, 2, 6, 7, 9, 3, 4))
    its, cells = [words(r, 3) for _ in range(3)], [words(r, 2) for _ in range(6)]
    rows = "".join(f"<tr><td>{cells[2 * i]}</td><td>{cells[2 * i + 1]}</td></tr>" for i in range(3))
    bodies = [
        (f"<section><h2>{h1}</h2><p>{a}</p></section><section><h2>{h2}</h2><p>{b}</p></section>", [h1, a, h2, b]),
        (f"<p>{a}</p><ol>" + "".join(f"<li>{x}</li>" for x in its) + f"</ol><p>{b}</p>", [a, *its, b]),
        (f"<p>{a}</p><table>{rows}</table><p>{b}</p>", [a, *cells, b]),
        (f"<p>{a}</p><figure><img src=x><figcaption>{cap}</figcaption></figure><p>{b}</p>", [a, cap, b]),
        (f"<p>{a}</p><dl><dt>{its[0]}</dt><dd>{its[1]}</dd><dt>{its[2]}</dt><dd>{quote}</dd></dl><p>{b}</p>", [a, its[0], its[1], its[2], quote, b]),
        (f"<p>{a}</p><blockquote>{quote}</blockquote><p>{b}</p>", [a, quote, b]),
        (f"<header><h1>{h1}</h1></header><p>{a}</p><p>{b}</p>", [h1, a, b]),
        (f"<p>{a}</p><pre>{pre}</pre><p>{b}</p>", [a, pre, b]),
        (f"<p>{s1}</p><p>{a}</p><p>{s2}</p><p>{b}</p>", [s1, a, s2, b]),
        (f"<p>{a[:40]} <a href=/x>{its[0]}</a> {a[40:]}</p><p>{b}</p>", [" ".join(f"{a[:40]} {its[0]} {a[40:]}".split()), b]),
    ]
    out = [(f"<!DOCTYPE html><html><head><title>t</title></head><body><nav>{menu}</nav>{o}{inner}{c}<footer>{foot}</footer></body></html>", kept) for inner, kept in bodies for o, c in (("<article>", "</article>"), ('<div class="q7">', "</div>"))]
    return [*out, (f"{a} {b}", [f"{a} {b}"]), (f"<b>{a}</b> <i>{b}</i>", [f"{a} {b}"])]
