"""Pages of layouts that training knows nothing of: hand-made ones, and a generator with names and phrases of its own."""

from __future__ import annotations

import random

from tests.llm.pages import A, B, C, D, p

NINE = {
    "data table": (f"<html><body><nav><a href=1>Front</a> <a href=2>Science</a></nav><article><h1>How the tower grew</h1>{p(A)}<table><tr><th>Year</th><th>Metres</th></tr><tr><td>2019</td><td>12</td></tr><tr><td>2020</td><td>19</td></tr></table>{p(B)}</article></body></html>", f"How the tower grew {A} Year Metres 2019 12 2020 19 {B}"),
    "definitions": (f"<body><header><a href=1>Glossarium</a></header><main><h1>Words of the debate</h1>{p(A)}<dl><dt>Quorum</dt><dd>The number of members that must be there.</dd><dt>Motion</dt><dd>What is put to the vote.</dd></dl>{p(C)}</main><footer>Press House 2023</footer></body>", f"Words of the debate {A} Quorum The number of members that must be there. Motion What is put to the vote. {C}"),
    "byline": (f'<body><div class="story-body"><h1>A late vote</h1><p>By Anna Keller</p>{p(A, B, C)}</div><div class="legal">© 2024 Keller Press</div></body>', f"A late vote By Anna Keller {A} {B} {C}"),
    "two paragraphs": (f'<body><div class="hd"><a href=1>Diary</a></div><div class="post"><p>{A}</p><p>More on Friday.</p></div></body>', f"{A} More on Friday."),
    "weather box": (f'<body><div class="content"><h1>A late vote</h1>{p(A, B)}</div><div class="side-column"><div class="box"><h3>Weather</h3><p>Sunny, 24 degrees</p></div><div class="box"><h3>Stocks</h3><p>DAX 15,210</p></div></div></body>', f"A late vote {A} {B}"),
    "paywall": (f'<body><article><h1>A late vote</h1>{p(A, B)}<div class="paywall"><p>Members read more. Join now for 3 euros a month.</p></div></article></body>', f"A late vote {A} {B}"),
    "figure": (f"<body><article><h2>A late vote</h2>{p(A)}<figure><img src=x><figcaption>The town hall at night</figcaption></figure>{p(B, D)}</article><section class='discussion'><p>Ulf wrote: nonsense!</p></section></body>", f"A late vote {A} The town hall at night {B} {D}"),
    "steps": (f'<body><ul class="topbar"><li><a href=1>Recipes</a></li><li><a href=2>Baking</a></li></ul><div id="recipe"><h1>Bread</h1><ul><li>500 g flour</li><li>1 spoon of salt</li></ul>{p(C, D)}</div><div class="bottom">Recipes since 1987</div></body>', f"Bread 500 g flour 1 spoon of salt {C} {D}"),
    "german": ('<body><div class="kopf"><a href=1>Startseite</a> <a href=2>Kultur</a></div><div class="text"><h1>Neues Museum</h1><p>Am Sonntag hat das neue Museum am Fluss seine Türen geöffnet, und mehr als tausend Menschen kamen.</p><p>Der Eintritt ist bis Ende des Monats frei.</p></div><div class="fuss">Alle Rechte vorbehalten 2020</div></body>', "Neues Museum Am Sonntag hat das neue Museum am Fluss seine Türen geöffnet, und mehr als tausend Menschen kamen. Der Eintritt ist bis Ende des Monats frei."),
}

_WORDS = "river harbour meeting winter teacher engine garden paper market window village morning doctor bridge story number season weather music island letter answer mountain summer people water bread train street".split()


def generated(seed: int, n: int = 120) -> list[tuple[str, str]]:
    """(html, text) of pages made of a random head, an article of varied parts, and random rest."""
    r = random.Random(seed)

    def sentence(lo=6, hi=18):
        words = [r.choice(_WORDS) if r.random() < 0.45 else r.choice(["the", "of", "a", "in", "was", "and", "that", "had", "with", "for", "it", "they"]) for _ in range(r.randrange(lo, hi))]
        return " ".join(words).capitalize() + "."

    def prose():
        return " ".join(sentence() for _ in range(r.randrange(2, 5)))

    out = []
    for _ in range(n):
        text: list[str] = []

        def own(tag, t, text=text):
            text.append(t)
            return f"<{tag}>{t}</{tag}>"

        parts = [own("h1", sentence(2, 6).rstrip("."))] if r.random() < 0.8 else []
        if r.random() < 0.3:
            parts.append(own("p", f"By {r.choice(['Ida Lund', 'Omar Reyes', 'Jo Park'])}"))
        for _ in range(r.randrange(2, 7)):
            parts.append(own("p", prose()))
            k = r.random()
            if k < 0.1:
                parts.append("<table>" + "".join("<tr>" + own("td", str(r.randrange(1900, 2030))) + own("td", f"{r.randrange(90)} tons") + "</tr>" for _ in range(3)) + "</table>")
            elif k < 0.2:
                parts.append("<ul>" + "".join(own("li", sentence(2, 7)) for _ in range(3)) + "</ul>")
            elif k < 0.27:
                parts.append("<dl>" + own("dt", r.choice(_WORDS)) + own("dd", sentence(4, 9)) + "</dl>")
            elif k < 0.33:
                parts.append(own("blockquote", sentence()))
            elif k < 0.4:
                parts.append('<div class="adbox">Visit our partners this weekend</div>')
        holder = r.choice([("<article>", "</article>"), ("<main>", "</main>"), ('<div class="article-text">', "</div>"), ('<div id="story">', "</div>"), ('<div class="kx9">', "</div>"), ("<div><div>", "</div></div>")])
        links = "".join(f"<li><a href=/{w}>{w.capitalize()}</a></li>" for w in r.sample(_WORDS, r.randrange(3, 7)))
        head = r.choice([f"<nav><ul>{links}</ul></nav>", f'<div class="menu"><ul>{links}</ul></div>', f'<header><div>The Island Courier</div><ul>{links}</ul></header>', ""])
        side = r.choice(["", "", f'<aside><h3>Readers liked</h3><ul>{links}</ul></aside>', f'<div class="sidebar"><h4>Elsewhere</h4><p>{sentence(3, 6)}</p></div>'])
        talk = r.choice(["", "", f'<section class="comments"><h3>Your views</h3><div class="comment"><p>{sentence(4, 9)}</p></div><div class="comment"><p>{sentence(4, 9)}</p></div></section>'])
        foot = r.choice(["<footer>© 2018 The Island Courier</footer>", '<div class="footer"><p>© 2018 The Island Courier. All rights kept.</p></div>', ""])
        note = r.choice(["", "", '<div class="cookie-bar">This page sets cookies.</div>'])
        body = head + holder[0] + "".join(parts) + holder[1] + side + talk + foot
        out.append((f"<html><body>{note}{body}</body></html>", " ".join(text)))
    return out
