"""Pages as another site would write them: wrappers, words and elements that no training copy has."""

from __future__ import annotations

import html
import random

NOUNS = (
    "river council bridge harvest engine orchard museum signal harbour teacher winter market"
    " letter forest station valley garden island theatre railway"
).split()
VERBS = (
    "crossed opened measured carried repaired followed described rebuilt visited counted painted"
    " answered closed delayed"
).split()
PLACES = [
    "near the old mill",
    "after the long strike",
    "before the spring floods",
    "in the northern district",
    "for a third year",
    "without much notice",
    "beside the canal",
]


def sentence(rng: random.Random) -> str:
    a, b, c = rng.sample(NOUNS, 3)
    did, then = rng.choice(VERBS), rng.choice(VERBS)
    return rng.choice(
        [
            f"The {a} {did} the {b} {rng.choice(PLACES)}.",
            f"Nobody {did} a {a} {rng.choice(PLACES)}, and the {b} {then} the {c} again.",
            f"When the {a} & the {b} {did} it, {rng.randint(3, 900)} people stayed at the {c}.",
        ]
    )


def _paragraph(rng: random.Random) -> str:
    return " ".join(sentence(rng) for _ in range(rng.randint(2, 7)))


def _linked(rng: random.Random, text: str) -> str:
    """A paragraph, some with a link or an emphasis on two of its words."""
    words = html.escape(text).split(" ")
    if rng.random() < 0.4:
        at = rng.randrange(len(words) - 2)
        open_tag, close_tag = rng.choice([(f"<a href='/x/{at}'>", "</a>"), ("<em>", "</em>")])
        words[at] = open_tag + words[at]
        words[at + 1] += close_tag
    return f"<p>{' '.join(words)}</p>"


def _story(rng: random.Random) -> tuple[list[str], list[str]]:
    """Elements of a main text, and its blocks."""
    title = f"{rng.choice(NOUNS).title()} {rng.choice(VERBS)} {rng.choice(PLACES)}"
    due, body = [title], [f"<h1>{title}</h1>"]
    for n in range(rng.randint(3, 9)):
        if n and rng.random() < 0.25:
            due.append(f"{rng.choice(NOUNS).title()} and {rng.choice(NOUNS)}")
            body.append(f"<h2>{due[-1]}</h2>")
        due.append(_paragraph(rng))
        body.append(_linked(rng, due[-1]))
        if rng.random() < 0.12:
            points = [sentence(rng) for _ in range(rng.randint(2, 4))]
            due += points
            body.append("<ul>" + "".join(f"<li>{html.escape(p)}</li>" for p in points) + "</ul>")
        if rng.random() < 0.1:
            due.append(_paragraph(rng))
            body.append(f"<blockquote><p>{html.escape(due[-1])}</p></blockquote>")
        if n and rng.random() < 0.12:
            body.append(
                rng.choice(
                    [
                        '<div class="dfp-slot"><p>Advertisement</p></div>',
                        f'<div class="promo-box"><a href="/o">{html.escape(sentence(rng))}</a></div>',
                        '<form action="/nl"><label>Your mail</label><input name="m">'
                        "<button>Send</button></form>",
                    ]
                )
            )
    return body, due


def page(rng: random.Random) -> tuple[str, str]:
    """A page and its main text."""
    body, due = _story(rng)
    wrapper = rng.choice(
        [
            '<main id="main">{}</main>',
            '<div class="post-body">{}</div>',
            '<div id="content"><div class="entry">{}</div></div>',
            '<section class="story">{}</section>',
            '<article class="a1">{}</article>',
            "<div><div><div>{}</div></div></div>",
            "<table><tr><td>{}</td></tr></table>",
        ]
    )
    main = wrapper.format("\n".join(body))

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{w}">{w.title()}</a></li>' for w in rng.sample(NOUNS, k))

    said = [html.escape(sentence(rng)) for _ in range(3)]
    top = rng.choice(
        [
            f'<header><a href="/">The Daily</a></header><nav><ol>{links(5)}</ol></nav>',
            f'<div id="masthead"><span>Site</span></div><div class="navbar"><ul>{links(7)}</ul></div>',
            f'<div role="navigation"><ul>{links(4)}</ul></div>',
        ]
    )
    side = rng.choice(
        [
            "",
            f"<aside><h4>Most read</h4><ul>{links(5)}</ul></aside>",
            '<div id="sidebar"><div class="widget"><h3>Related</h3>'
            f'<p><a href="/q">{said[0]}</a></p></div></div>',
        ]
    )
    notice = rng.choice(
        [
            "",
            "",
            '<div class="cookie-consent"><p>We use cookies to count visits. By reading on you agree'
            " to this.</p><button>Fine</button></div>",
        ]
    )
    talk = "".join(f'<div class="comment"><b>user</b><p>{text}</p></div>' for text in said[1:])
    talk = rng.choice(["", "", f'<section id="comments"><h3>2 comments</h3>{talk}</section>'])
    foot = rng.choice(
        [
            "<footer><p>&copy; 2024 The publisher. All rights reserved.</p></footer>",
            '<div class="footer"><a href="/about">About</a> <a href="/terms">Terms</a></div>',
        ]
    )
    parts = [top, *rng.sample([side, main], 2), talk, foot]
    parts.insert(rng.choice([0, len(parts)]), notice)
    inside = "\n".join(parts)
    return (
        f"<!doctype html>\n<html>\n<head><title>{due[0]}</title><script>var a = 1 < 2;</script></head>"
        f"\n<body>\n{inside}\n</body></html>",
        "\n".join(due),
    )
