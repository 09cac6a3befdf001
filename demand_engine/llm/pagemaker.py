"""Practice pages for the block labeller: texts of sampled pages in made-up
layouts, with the answer to each block.

A block of main text starts with ``MARK``, which the reader of practice pages
takes away. Layouts vary in tags, class words, order and nesting, and some
have no telling names at all, so that the labeller learns to use a block's
neighbours, words and links too.
"""

from __future__ import annotations

import random
from html import escape

MARK = "\ue000"

# Usual names of page parts in HTML, and usual short texts.
MAIN = "content post entry article story article-body post-content entry-content main-content text body-text article__body".split()
PARTS = {
    "menu": "nav menu navbar navigation main-menu top-nav site-nav breadcrumb breadcrumbs pagination".split(),
    "header": "header site-header masthead topbar page-header branding".split(),
    "footer": "footer site-footer page-footer bottom colophon copyright legal".split(),
    "side": "sidebar side widget widget-area related related-posts recommended popular aside rail tags tag-list author-box".split(),
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner ad-banner".split(),
    "notice": "notice cookie cookie-banner cookie-consent consent gdpr alert popup modal overlay newsletter subscribe disclaimer".split(),
    "form": "form search search-form login signup contact-form newsletter-form poll".split(),
    "comments": "comments comment-list comment discussion replies responses disqus user-comments".split(),
    "share": "share social share-buttons sharing toolbar social-links".split(),
}
TAGS = {"menu": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "side": ["aside", "div", "section"], "advert": ["div", "aside", "section"],
        "notice": ["div", "section", "aside"], "form": ["form"], "comments": ["section", "div", "ol"], "share": ["div", "ul"]}
SAYS = {
    "menu": "Home|About|Contact|News|Products|Blog|Help|Shop|Log in|Next page|Previous|Start|Accueil|Inicio|Kontakt|Sport".split("|"),
    "header": "Welcome to our site|The daily letter|Skip to content|Search|My account".split("|"),
    "footer": "© 2024 All rights reserved.|Privacy policy|Terms of use|Powered by our own engine|Impressum|Contact us|Sitemap|Cookie settings".split("|"),
    "side": "Related articles|Most read|You may also like|Popular posts|About the author|Tags|Recent comments|Archive".split("|"),
    "advert": "Advertisement|Sponsored|Buy now and save|Sale ends today, shop the new collection|Get 20% off your first order|Anzeige|Publicité".split("|"),
    "notice": "We use cookies to give you the best experience on our site.|Accept all|This site uses cookies.|Subscribe to our newsletter|Sign up for free|You have one free article left this month.|Please enable JavaScript.".split("|"),
    "form": "Name|E-mail|Your message|Send|Search|Password|Choose a country|Submit|I agree to the terms".split("|"),
    "comments": "Comments|Leave a reply|Reply|3 comments|Posted by guest on 12 May|Great article, thanks!|Report".split("|"),
    "share": "Share|Tweet|Print|E-mail this|Share on social media|Follow us|Like".split("|"),
}


class PageMaker:
    """Makes pages from ``main`` texts and ``other`` texts of real pages."""

    def __init__(self, main: list[str], other: list[str], seed: int):
        self.rnd = random.Random(seed)
        self.main, self.other = main, other

    def _open(self, tag: str, names: list[str]) -> str:
        r = self.rnd
        if tag == "div" or r.random() < 0.5:
            kind = r.choice(("class", "class", "id"))
            return f'<{tag} {kind}="{r.choice(names)}">' if r.random() < 0.93 else f"<{tag}>"
        return f"<{tag}>"

    def _words(self, low: int, high: int) -> str:
        words = self.rnd.choice(self.main).split()
        n = self.rnd.randint(low, high)
        at = self.rnd.randrange(max(1, len(words) - n + 1))
        return " ".join(words[at : at + n])

    def _part(self, kind: str, loud: bool = True) -> str:
        """One part of the frame around the main text. Where it is not
        ``loud`` its tags and names say nothing."""
        r = self.rnd
        tag = r.choice(TAGS[kind]) if loud else "div"
        say = lambda: r.choice(SAYS[kind]) if r.random() < 0.5 else (r.choice(self.other) if r.random() < 0.5 else self._words(1, 6))
        link = lambda x: f'<a href="/{r.randrange(999)}">{escape(x)}</a>'
        if kind in ("menu", "share"):
            items = [link(say()) for _ in range(r.randint(2, 9))]
            inner = "".join(f"<li>{x}</li>" for x in items) if tag == "ul" else "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if r.random() < 0.7 else " ".join(items)
        elif kind == "form":
            inner = "".join(r.choice((f"<label>{escape(say())}</label><input>", f"<p>{escape(say())}</p>", f"<button>{escape(say())}</button>", f"<select><option>{escape(say())}<option>{escape(say())}</select>")) for _ in range(r.randint(1, 5)))
        elif kind == "comments":
            inner = f"<h3>{escape(say())}</h3>" + "".join(f'<{"li" if tag == "ol" else "div"} class="{r.choice(("comment", "reply", "comment-body"))}"><p>{escape(say())}</p><p>{escape(self._words(3, 60))}</p></{"li" if tag == "ol" else "div"}>' for _ in range(r.randint(1, 6)))
        elif kind in ("side", "header") and r.random() < 0.6:
            inner = f'<h{r.randint(1, 4)}>{escape(say())}</h{r.randint(1, 4)}>' + "<ul>" + "".join(f"<li>{link(self._words(2, 9))}</li>" for _ in range(r.randint(1, 6))) + "</ul>"
        else:
            texts = [say() if r.random() < 0.7 else self._words(4, 40) for _ in range(r.randint(1, 3))]
            inner = "".join(r.choice((f"<p>{escape(x)}</p>", f"<div>{escape(x)}</div>", f"<span>{escape(x)}</span> ", link(x))) for x in texts)
            inner = escape(texts[0]) if r.random() < 0.3 else inner
        return (self._open(tag, PARTS[kind]) if loud else "<div>") + inner + f"</{tag}>"

    def _article(self, plain: bool) -> str:
        r = self.rnd
        text = lambda x: MARK + escape(x)
        out = []
        if r.random() < 0.8:
            head = f"<h{r.randint(1, 2)}>{text(self._words(2, 12))}</h1>"
            out.append(f"<header>{head}</header>" if not plain and r.random() < 0.25 else head)
        for _ in range(r.randint(1, 14)):
            body = r.choice(self.main) if r.random() < 0.7 else self._words(1, 12)
            kind = r.random()
            if kind < 0.72:
                out.append(r.choice(("<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p>{}</p>")).format(text(body)))
            elif kind < 0.8:
                out.append(f"<h{r.randint(2, 4)}>{text(self._words(1, 8))}</h3>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{text(self._words(2, 25))}" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.91:
                out.append(f"<blockquote><p>{text(body)}</p></blockquote>")
            elif kind < 0.94:
                out.append("<table><tr>" + "".join(f"<td>{text(self._words(1, 5))}</td>" for _ in range(r.randint(1, 4))) + "</tr></table>")
            elif kind < 0.97:
                out.append(f"<figure><img><figcaption>{text(self._words(2, 12))}</figcaption></figure>")
            else:
                out.append(f"<pre>{text(body)}</pre>")
            if r.random() < 0.05:
                out.append(self._part(r.choice(("advert", "share", "side", "notice", "form"))))
        if r.random() < 0.12:
            out.append(self._part("comments"))
        return "".join(out)

    def page(self) -> str:
        r = self.rnd
        if r.random() < 0.05:  # no frame at all
            return MARK + escape(r.choice(self.main)) if r.random() < 0.3 else self._article(True)
        loud = r.random() < 0.85  # otherwise nothing but div and p around the main text
        before = [k for k, p in (("notice", 0.2), ("header", 0.5), ("menu", 0.75), ("advert", 0.4), ("form", 0.12), ("share", 0.12), ("side", 0.2)) if r.random() < p]
        after = [k for k, p in (("share", 0.2), ("comments", 0.35), ("side", 0.35), ("advert", 0.2), ("form", 0.2), ("menu", 0.2), ("footer", 0.8), ("notice", 0.15)) if r.random() < p]
        if r.random() < 0.2:
            r.shuffle(before)
        inner = self._article(not loud)
        style = r.random()
        if not loud:
            inner = f"<div>{inner}</div>" if r.random() < 0.8 else inner
        elif style < 0.4:
            inner = f"{self._open('article', MAIN)}{inner}</article>"
        elif style < 0.6:
            inner = f"{self._open('main', MAIN)}{inner}</main>"
        else:
            inner = f'<div class="{r.choice(MAIN)}">{inner}</div>'
        if loud and r.random() < 0.4:
            inner = f'<{r.choice(("main", "section", "div"))} class="{r.choice(MAIN)}">{inner}</div>'
        if loud and r.random() < 0.3:
            inner = f'<div class="{r.choice(("container", "wrapper", "page", "row", "col", "layout"))}">{inner}'
        inside = "".join(self._part(k, loud) for k in before) + inner + "".join(self._part(k, loud) for k in after)
        return f"<html><head><title>x</title></head><body>{inside}</body></html>" if r.random() < 0.9 else inside
