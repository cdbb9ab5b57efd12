"""Labelled pages for training: assembled from marked-up parts whose role is known, with all layouts in turn."""

from __future__ import annotations

import random

#: Stands in front of every block of main text in a labelled page.
MARK = "\ue000"
SYLLABLES = "ka lo mi ter an sel vo ri den pas tu cor el ma nis".split()

#: Where main text stands; {} is the text.
MAIN = ["<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div id="content">{}</div>', '<div class="post-body">{}</div>', '<section class="entry-content">{}</section>', '<div class="article-text"><div>{}</div></div>', '<div role="main">{}</div>', '<div class="main-column"><div class="story">{}</div></div>', "<div>{}</div>", "{}", "<table><tr><td>{}</td></tr></table>", "<table><tbody><tr><td>{}</td><td></td></tr></tbody></table>", "<center>{}</center>"]
#: Of so many pages one is plain: a few short blocks without a container, beside two other parts at most.
PLAIN = 4
#: Other parts of a page; L is a list of links, S a sentence, W a few words.
OTHER = [
    "<nav><ul>L</ul></nav>", '<div class="menu"><ul>L</ul></div>', '<ul id="navigation">L</ul>', '<div class="breadcrumb"><a href="/">W</a> W</div>', '<div class="pagination"><a href="/2">W</a></div>',
    "<header><h1>W</h1><p>S</p></header>", '<div class="header"><h2>W</h2></div>', '<div id="masthead"><a href="/">W</a></div>', "<header><a href='/'>W</a></header>",
    "<footer>&copy; W &middot; S</footer>", "<footer><p>S</p><ul>L</ul></footer>", '<div class="footer"><p>S</p></div>', '<div id="copyright">S</div>',
    "<aside><h3>W</h3><p>S</p></aside>", '<div class="sidebar"><h4>W</h4><ul>L</ul></div>', '<div class="widget"><p>S S</p></div>', '<div class="related"><h3>W</h3><ul>L</ul></div>', '<div class="share"><a href="/s">W</a></div>',
    '<div class="ad">S</div>', '<div class="ad">S\nS</div>', '<div class="ads"><p>S S</p></div>', '<div class="advert"><a href="/x">S</a></div>', '<div class="banner">S</div>', '<div class="sponsored"><p>S</p></div>', '<div class="promo">S</div>', '<ins class="adsbygoogle">W</ins>',
    '<div class="notice">S</div>', '<div class="cookie-notice"><p>S S</p><button>W</button></div>', '<div id="consent"><p>S</p></div>', '<div class="alert">S</div>', '<div class="newsletter"><p>S</p></div>', '<div class="popup"><p>S</p></div>',
    "<form><label>W</label><select><option>W</option><option>W</option></select><textarea>S</textarea><button>W</button></form>", '<form class="search"><p>S</p><input type="text"><button>W</button></form>', '<div class="subscribe"><form><p>S</p></form></div>',
    '<section class="comments"><h3>W</h3><p>S S</p><p>S</p></section>', '<div id="comments"><div class="comment"><p>S S S</p></div><div class="comment"><p>S</p></div></div>', '<div class="comment-list"><article class="comment"><p>S S</p></article></div>', '<ol class="replies"><li><p>S S</p></li></ol>', '<div class="disqus">S</div>',
    "<script>var a = 1;</script>", "<style>p{margin:0}</style>", "<!-- S -->", "<noscript>S</noscript>",
]
#: Parts that also stand inside the main text.
INSIDE = [x for x in OTHER if any(k in x for k in ("<aside", "<form", "<nav", "ad", "notice", "comment", "related", "share", "newsletter", "footer>&copy"))]


def labelled_pages(n: int = 420, seed: int = 11) -> list[str]:
    """``n`` pages in which every block of main text starts with ``MARK``."""
    r = random.Random(seed)
    word = lambda: "".join(r.choices(SYLLABLES, k=r.randint(1, 4)))
    words = lambda low, high: " ".join(word() for _ in range(r.randint(low, high)))
    sentence = lambda: words(3, 22).capitalize() + r.choice([".", ".", "?", "!", ""])

    def filled(part: str) -> str:
        out = []
        for c in part.replace("L", "\x01").replace("S", "\x02").replace("W", "\x03"):
            links = "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(r.randint(2, 6))) if c == "\x01" else ""
            out.append(links or (sentence() if c == "\x02" else words(1, 4) if c == "\x03" else c))
        return "".join(out)

    def block(i: int) -> str:
        text = MARK + " ".join(sentence() for _ in range(r.choice([0, 0, 1, 2, 4, 8]))) + words(1, 3)
        if r.random() < 0.15:
            text += f' <a href="/{word()}">{words(1, 3)}</a> {words(1, 4)}'
        return r.choice([f"<p>{text}</p>"] * 6 + [f"<p><b>{text}<br>", f"<h2>{text}</h2>", f"<blockquote><p>{text}</p></blockquote>", f"<ul><li>{text}</li></ul>", f"<pre>{text}</pre>"])

    pages = []
    for i in range(n):
        plain = i % PLAIN == 1
        main = r.choice(["{}", "{}", "<div>{}</div>", "<table><tr><td>{}</td></tr></table>"]) if plain else MAIN[i % len(MAIN)]
        title = words(2, 8)
        parts = ([f"<h1>{MARK}{title}</h1>"] if r.random() < (0.3 if plain else 0.8) else []) + [block(k) for k in range(r.choice([1, 1, 1, 2] if plain else [1, 1, 2, 4, 8, 16]))]
        if plain:
            parts = [p if r.random() < 0.3 else f"<{t}>{MARK}{words(1, 9)}{r.choice(['.', '.', ''])}</{t}>" for p in parts for t in [r.choice(["p", "p", "div", "td", "li"])]]
        elif r.random() < 0.6:
            parts.insert(r.randint(1, len(parts)), filled(r.choice(INSIDE)))
        before, after = ([filled(OTHER[(i * 7 + k * 13 + s) % len(OTHER)]) for k in range(r.choice([0, 0, 1]) if plain else r.randint(0, 4))] for s in (0, 5))
        body = "".join([*before, main.format("".join(parts)), *after])
        if plain and r.random() < 0.4:  # a fragment of a page
            pages.append(body)
            continue
        pages.append(f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{body}</body></html>")
    return pages
