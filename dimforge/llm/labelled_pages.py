"""Pages labelled by hand, from which the extractor of main text learns.

``keep`` on an element says whether text directly in it and below belongs to the
article (1) or not (0), until an element below says otherwise.  The attribute is
taken out before learning.  Each layout comes with names on its elements and
without, so that lengths, links and the shape of the tree have to speak too.
"""

from __future__ import annotations

import re

SENTENCES = ("The committee met again on Tuesday, and after a debate of several hours it agreed to publish the full report.",
             "Members of both sides welcomed the decision.", "It was late, and few were left.",
             "Among the figures that had been held back were those of the bridge, the harbour and the two schools.", "Why now?",
             "Nobody had asked for them before the summer", "Work begins in spring.",
             "The mayor, who had opposed it, said that the town could not wait for another year, another vote and another bill.")


def _text(k: int, sentences: int) -> str:
    return " ".join(SENTENCES[(k * 3 + i) % len(SENTENCES)] for i in range(sentences)) + " "


# Fixed values of common page layouts: the elements that hold an article, outermost first.
STORY_PLACES = [("article",), ("main",), ("main", "article"), ('div class="content"',), ('div class="post entry"', "div"),
                ('div id="story"',), ('div class="article-body text"',), ("section",), ('section class="article"', "div"),
                ("div",), ("div", "div"), ("div", 'div class="column"', "section"), ("table", "tr", "td"),
                ('div role="main"',), ("center",)]
# Fixed values of common page layouts: class names of blocks beside the article.
NOISE_CLASSES = ("sidebar", "ad", "advert", "ads banner", "advertisement", "ad-box", "top ads", "cookie notice", "consent", "newsletter signup",
                 "related posts", "recommended", "share social", "menu nav", "navigation", "breadcrumb", "comments",
                 "comment-list", "comment reply", "footer", "header top", "masthead", "popup modal", "promo sponsored",
                 "widget", "login form", "pagination pager", "copyright legal", "toolbar", "author-bio", "tags", "subscribe",
                 "alert message", "disclaimer", "search", "rating", "feedback", "trending", "outbrain")
NOISE_TAGS = ("div", "section", "aside", "ul", "div", "ol")


def _paragraphs(k: int, n: int) -> str:
    return "".join(f"<p>{_text(k + i, 1 + (k + 2 * i) % 7)}</p>" for i in range(n))


def _links(words: str) -> str:
    return "".join(f'<li><a href="/{w}">{w}</a></li>' for w in words.split())


def _within(place: tuple, inner: str, keep: int) -> str:
    """``inner`` in the elements of ``place``, the innermost one labelled."""
    out = inner
    for depth, tag in enumerate(reversed(place)):
        label = f' keep="{keep}"' if depth == 0 else ""
        out = f"<{tag}{label}>{out}</{tag.split()[0]}>"
    return out


def _unnamed(html: str) -> str:
    return re.sub(r' (?:class|id|role)="[^"]*"', "", html)


def _story(k: int) -> str:
    short, long = _text(k, 1), _text(k, 3 + k % 4)
    title = f"<h1>{_text(k + 1, 1)}</h1>"
    listed = f"<ul><li>{long}</li><li>{short}</li></ul>"
    table = f"<table><tr><td>{short}</td><td>12</td></tr><tr><td>{long}</td><td>7</td></tr></table>"
    linked = f'<p>{long}As <a href="/r">the report</a> says, {short}</p>'
    return (
        title + _paragraphs(k, 3),
        f"{title}<p>{short}</p>{_paragraphs(k, 5 + 3 * (k % 9))}<p>{short}</p>",
        f"{title}<p>{short}</p><p>{long}</p>",
        f"<h2>{short}</h2><blockquote><p>{long}</p></blockquote>{listed}{linked}<pre>a = b</pre>",
        f"{_paragraphs(k, 2)}<h2>{short}</h2>{table}<h3>And then</h3><p>{short}</p>{linked}",
        f"{title}<div><p>{long}</p><div><p>{long}</p></div></div><figure><figcaption>{short}</figcaption></figure>",
        f"{title}{long}<br><br>{long}<div>{long}</div>{short}",
        f"{title}<div>{_paragraphs(k, 4)}</div><div>{long}</div><dl><dt>One</dt><dd>{long}</dd></dl>",
        f"<p>{short}</p>{_paragraphs(k, 12)}<p>{short}</p>",
    )[k % 9]


def _noise(k: int) -> list[str]:
    """Blocks of one class name: talk as long as the article's, links, and both in deeper elements."""
    name, tag = NOISE_CLASSES[k % len(NOISE_CLASSES)], NOISE_TAGS[k % len(NOISE_TAGS)]
    inner = "li" if tag in ("ul", "ol") else "p"
    talk, short = _text(k, 1 + k % 5), _text(k + 1, 1)
    many = "".join(f"<{inner}>{_text(k + i, 1 + i % 4)}</{inner}>" for i in range(2 + 5 * (k % 4)))
    return [
        f'<{tag} class="{name}" keep="0">{many}</{tag}>',
        f'<div class="{name}" keep="0">{talk}</div>',
        f'<div class="{name}" keep="0"><h3>More</h3><ul>{_links("One Two Three Four")}</ul><p>{short}</p></div>',
        f'<section id="{name.split()[0]}" keep="0"><div><div><p>{talk}</p><p>{short}</p></div></div></section>',
    ]


def pages() -> list[str]:
    """The labelled pages: each place of a story with kinds of noise in turn, then the same without names."""
    nav = f'<nav keep="0"><ul>{_links("Home News Sport Weather Contact")}</ul></nav>'
    list_nav = f'<div class="menu" keep="0"><ul>{_links("Home News Sport Weather Contact About")}</ul></div>'
    div_foot = '<div class="bottom" keep="0"><p>&copy; Example Media. <a href="/imprint">Imprint</a> <a href="/terms">Terms</a></p></div>'
    out = []
    for k in range(4 * len(NOISE_CLASSES)):
        short, long, story = _text(k + 2, 1), _text(k, 2 + k % 4), _story(k // 2)
        head = (f'<header keep="0"><h2>Example</h2><p>{short}</p></header>', '<header keep="0"><h1>Example</h1></header>',
                f'<header class="top" keep="0"><div><h1>Example</h1></div><p>{short}</p></header>')[k // 4 % 3]
        aside = f'<aside keep="0"><h4>Read on</h4><p>{long}</p></aside>'
        form = f'<form keep="0"><label>Your name</label><p>{short}</p></form>'
        teasers = '<div keep="0"><h3>More</h3><ul>' + "".join(
            f'<li><a href="/{i}">{_text(k + i, 1)}</a></li>' for i in range(6)) + "</ul></div>"
        unseen = f'<div style="display: none" keep="0"><p>{long}</p></div>'
        foot = ('<footer keep="0">&copy; Example Media, all rights reserved. <a href="/imprint">Imprint</a></footer>',
                f'<footer keep="0">&copy; example.com &middot; {short}{_text(k + 5, 1)}</footer>',
                f'<footer keep="0"><p>{_text(k, 1 + k % 4)}</p><p>&copy; Example Media</p></footer>')[k % 7 % 3]
        place, noise, more = STORY_PLACES[k % len(STORY_PLACES)], _noise(k), _noise(k + 11)
        held = _within(place, story, 1)
        mixed = _within(place, story + noise[k % 4] + _paragraphs(k, 1), 1)
        layouts = [
            (f'<body keep="0">{nav}{noise[1]}{held}{foot}</body>', f'<body keep="0">{list_nav}{unseen}{held}{div_foot}</body>'),
            (f'<body keep="0">{head}{nav}{held}{noise[2]}{foot}</body>', f'<body keep="0">{head}{nav}{held}{teasers}{foot}</body>'),
            (f'<body keep="0"><div id="page" keep="0">{list_nav}{mixed}{more[0]}{form}{div_foot}</div></body>',
             f'<body keep="0"><div keep="0">{list_nav}{held}{teasers}{form}</div>{div_foot}</body>'),
            (f'<body keep="0">{nav}{noise[0]}{mixed}{aside}{noise[3]}{more[1]}{foot}</body>',
             f'<body keep="0">{nav}<div keep="0"><div keep="0">{held}</div>{aside}</div>{foot}</body>'),
        ]
        named, plain = layouts[k % len(layouts)]
        out += [f"<html>{named}</html>", f"<html>{_unnamed(plain)}</html>"]
        if k % 3 == 0:
            out.append(f'<html><body keep="1">{head}{nav}{story}{noise[k % 4]}<p>{short}</p>{foot}</body></html>')
            out.append(f'<html><body keep="0">{nav}<div class="ad" keep="0">{_text(k, 1 + k % 2)}</div><article keep="1"><h1>{short}</h1><p>{_text(k, 1 + k % 3)}</p></article>'
                       f'{noise[1]}{more[2]}{unseen}{foot}</body></html>')
    return out
