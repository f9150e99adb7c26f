"""Labelled pages for training the HTML extractor, composed from a fixed seed.

Each page is an article in one of several wrappings, with menus, banners,
sidebars, adverts, notices, forms, related links, reader comments and footers
around and inside it, in tags and class names as pages have them, some of them
without any names and some with broken markup. Of both kinds some elements are hidden (menus
that open on a click, articles that a script shows). Some pages have no
wrapping: bare paragraphs, running text, or plain text without markup.
"""

from __future__ import annotations

import html
import random

SYLLABLES = "an be ca de el fi go ha in jo ka le mo na or pa qui re so ta un ve wa ya zu sch tion ment é ü ñ".split()
#: Parts of class names and ids by kind of block.
NAMES = {
    "header": "header masthead top branding site-header page-header pageHeader logo",
    "nav": "nav menu navbar navigation main-nav site-menu topnav mainMenu tabs breadcrumb breadcrumbs pager pagination toc",
    "ad": "ad ads advert advertisement sponsored promo adsense ad-slot banner-ad dfp sponsor",
    "notice": "notice alert cookie cookie-notice consent message banner warning gdpr popup modal overlay disclaimer announcement",
    "side": "sidebar side widget aside rail right-col widget-area secondary sidebar-left",
    "related": "related more-links recommended read-next popular trending tags tag-list also see-also latest",
    "share": "share social sharing follow share-bar social-links toolbar tools",
    "comments": "comments comment-list discussion responses replies disqus reader-comments user-comments",
    "comment": "comment reply comment-body response comment-text",
    "form": "search newsletter subscribe login signup contact-form form",
    "footer": "footer site-footer bottom copyright legal page-footer foot colophon",
    "main": "content article post entry main story body post-content entry-content article-body articleBody text main-content page-content hentry",
    "wrap": "wrapper container page row col layout site wrap inner grid",
}
NAMES = {k: v.split() for k, v in NAMES.items()}
ROLES = {"header": "banner", "nav": "navigation", "side": "complementary", "form": "search", "footer": "contentinfo", "main": "main"}
TAGS = {
    "header": ["header", "header", "div"], "nav": ["nav", "nav", "div"], "ad": ["div", "aside", "section", "ins"],
    "notice": ["div", "section", "aside", "p"], "side": ["aside", "aside", "div"], "related": ["div", "section", "aside", "nav"],
    "share": ["div", "ul"], "comments": ["section", "div", "div", "ol", "ul"], "footer": ["footer", "footer", "div"],
}


class Page:
    def __init__(self, rng: random.Random):
        self.rng, self.wanted = rng, set()
        self.named = rng.random() < 0.85  # otherwise tags only

    def words(self, n: int) -> str:
        rng = self.rng
        out = ["".join(rng.choice(SYLLABLES) for _ in range(rng.choice((1, 2, 2, 3)))) for _ in range(max(1, n))]
        if rng.random() < 0.1:  # junk texts
            out = [w + rng.choice(["###", "&amp;&amp;", "***", "|", "%%%", ""]) for w in out]
        for i in range(0, len(out), rng.randint(5, 14)):
            out[i] = out[i].capitalize()
            if i:
                out[i - 1] += rng.choice([".", ".", ",", "!", "?"])
        return " ".join(out)

    def attrs(self, kind: str) -> str:
        rng = self.rng
        if not self.named or rng.random() < 0.1:
            return ""
        name = rng.choice(NAMES[kind])
        if rng.random() < 0.3:
            name += " " + rng.choice(["box", "block", "clearfix", "js-x", "w100", name + "-inner", "module"])
        if kind in ROLES and rng.random() < 0.15:
            return f' role="{ROLES[kind]}"'
        return f' {rng.choice(["class", "class", "class", "id"])}="{name}"'

    def block(self, kind: str, inner: str) -> str:
        tag = self.rng.choice(TAGS[kind])
        attrs = self.attrs(kind)
        if tag in ("div", "p", "section", "ul", "ol", "ins") and not attrs and kind != "notice":
            attrs = f' class="{self.rng.choice(NAMES[kind])}"'
        return f"<{tag}{attrs}{self.concealed(0.08)}>{inner}</{tag}>"

    def concealed(self, share: float) -> str:
        rng = self.rng
        return rng.choice([" hidden", ' aria-hidden="true"', ' style="display:none"']) if rng.random() < share else ""

    def links(self, a: int, b: int, most: int = 3) -> str:
        items = [f'<a href="/{i}">{self.words(self.rng.randint(1, most))}</a>' for i in range(self.rng.randint(a, b))]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.rng.choice([" | ", " ", " &middot; "]).join(items)

    def prose(self, a: int, b: int) -> str:
        return "".join(f"<p>{self.words(int(2 ** self.rng.uniform(0, 7)))}</p>" for _ in range(self.rng.randint(a, b)))

    def boilerplate(self, kind: str) -> str:
        rng = self.rng
        if kind == "header":
            return self.block("header", rng.choice([f"<h1>{self.words(2)}</h1>", f"<div>{self.words(3)}</div>", ""]) + (self.boilerplate("nav") if rng.random() < 0.5 else f"<p>{self.words(5)}</p>"))
        if kind == "nav":
            return self.block("nav", self.links(2, 12, 2))
        if kind == "noscript":
            return f"<noscript>{self.words(int(2 ** rng.uniform(1, 4)))}</noscript>"
        if kind == "ad":
            return self.block("ad", rng.choice([self.words(int(2 ** rng.uniform(0, 6))), self.prose(1, 2), f'<a href="/b">{self.words(8)}</a>']))
        if kind == "notice":
            return self.block("notice", rng.choice([self.words(int(2 ** rng.uniform(1, 6))), f"<p>{self.words(int(2 ** rng.uniform(1, 6)))}</p><button>Ok</button>"]))
        if kind == "side":
            return self.block("side", "".join(f"<div{self.attrs('side')}><h3>{self.words(2)}</h3>{rng.choice([self.links(2, 8, 6), self.prose(1, 2)])}</div>" for _ in range(rng.randint(1, 3))))
        if kind == "related":
            return self.block("related", f"<h3>{self.words(2)}</h3>" + self.links(2, 8, 9))
        if kind == "share":
            return self.block("share", self.links(2, 5, 1))
        if kind == "form":
            return f'<form{self.attrs("form")}><label>{self.words(2)}</label><input name="q"><p>{self.words(rng.randint(2, 15))}</p><button>{self.words(1)}</button></form>'
        if kind == "comments":
            one = lambda: f"<{(t := rng.choice(['div', 'li', 'article']))}{self.attrs('comment') or ' class=comment'}><b>{self.words(1)}</b>{self.prose(1, 3)}</{t}>"
            plain = lambda: f"<li>{self.words(int(2 ** rng.uniform(1, 7)))}</li>"
            one = plain if rng.random() < 0.2 else one
            title = f"<h2>{self.words(2)}</h2>" if rng.random() < 0.7 else ""
            return self.block("comments", title + "".join(one() for _ in range(rng.randint(1, 6))))
        return self.block("footer", rng.choice([f"&copy; {self.words(3)} &middot; {self.words(rng.randint(2, 9))}", f"<p>{self.words(8)}</p>" + self.links(2, 6)]))

    def want(self, n: int) -> tuple[str, str]:
        """Text for a wanted block, as markup and as it reads."""
        raw = self.words(n)
        text = html.unescape(raw)
        self.wanted.add(text)
        words = raw.split(" ")
        if len(words) > 6 and self.rng.random() < 0.3:  # inline markup
            i = self.rng.randint(0, len(words) - 4)
            tag = self.rng.choice(["b", "i", "em", 'a href="/x"', "code", "span", "strong"])
            words[i] = f"<{tag}>{words[i]}"
            words[i + 2] += f"</{tag.split()[0]}>"
        return " ".join(words), text

    def paragraph(self) -> str:
        rng = self.rng
        kind = rng.random()
        size = int(2 ** rng.uniform(0, 7.5))
        if kind < 0.08:
            return f"<p><b>{self.want(size)[0]}<br>"  # not closed
        if kind < 0.14:
            return f"<div>{self.want(size)[0]}</div>"
        if kind < 0.2:
            return f"<h{(n := rng.randint(2, 4))}>{self.want(rng.randint(1, 7))[0]}</h{n}>"
        if kind < 0.26:
            t, linked = rng.choice(["ul", "ol"]), rng.random() < 0.2
            a, b = ("<a href=/x>", "</a>") if linked else ("", "")
            return f"<{t}>" + "".join(f"<li>{a}{self.want(rng.randint(2, 20))[0]}{b}</li>" for _ in range(rng.randint(2, 6))) + f"</{t}>"
        if kind < 0.3:
            return f"<blockquote><p>{self.want(size)[0]}</p></blockquote>"
        if kind < 0.32:
            return f"<figure><img src=x><figcaption>{self.want(rng.randint(2, 12))[0]}</figcaption></figure>"
        if kind < 0.34:
            return f"<noscript>{self.want(size)[0]}</noscript>"
        return f"<p{self.concealed(0.03)}>{self.want(size)[0]}</p>"

    def article(self) -> str:
        rng = self.rng
        parts = [f"<h1>{self.want(rng.randint(1, 10))[0]}</h1>"] if rng.random() < 0.85 else []
        if parts and rng.random() < 0.15:
            parts = [f"<header>{parts[0]}</header>"]
        parts += [self.paragraph() for _ in range(rng.choice([0, 1, 1, 2, 4, 8, 15]) if parts else rng.randint(1, 8))]
        for kind in ("ad", "share", "related", "form", "notice"):
            if rng.random() < 0.12:
                parts.insert(rng.randint(min(1, len(parts)), len(parts)), self.boilerplate(kind))
        if rng.random() < 0.1:
            parts.append(self.boilerplate("comments"))
        inner = "".join(parts)
        kind = rng.random()
        if kind < 0.35:
            return f"<article{self.attrs('main') if rng.random() < 0.4 else ''}{self.concealed(0.05)}>{inner}</article>"
        if kind < 0.5:
            return f"<main{self.attrs('main') if rng.random() < 0.4 else ''}{self.concealed(0.05)}>{inner}</main>"
        if kind < 0.65:
            return f"<main><article>{inner}</article></main>"
        name = rng.choice(NAMES["main"])
        tag = rng.choice(["div", "div", "section", "td"])
        body = f'<{tag} class="{name}"{self.concealed(0.05)}>{inner}</{tag}>'
        if tag == "td":
            body = f"<table><tr>{body}</tr></table>"
        return f'<div id="{rng.choice(NAMES["main"])}">{body}</div>' if kind < 0.85 else body

    def bare(self) -> str:
        """A page without a wrapping: everything is main text, but for a menu or footer at times."""
        rng = self.rng
        kind = rng.random()
        if kind < 0.25:
            return self.want(int(2 ** rng.uniform(0, 8)))[0] if rng.random() < 0.5 else self.plain(rng.randint(1, 200))
        if kind < 0.5:
            body = self.want(int(2 ** rng.uniform(0, 8)))[0]
        else:
            body = "".join(f"<p>{self.want(int(2 ** rng.uniform(0, 7)))[0]}</p>" for _ in range(rng.choice([1, 1, 2, 3, 6, 12])))
            if rng.random() < 0.3:
                body = f"<h1>{self.want(rng.randint(1, 8))[0]}</h1>{body}"
        if rng.random() < 0.3:
            body = self.boilerplate("nav") + body if rng.random() < 0.5 else body + self.boilerplate("footer")
        return rng.choice([f"<html><body>{body}</body></html>", f"<body>{body}", body])

    def plain(self, n: int) -> str:
        """Text without markup."""
        text = html.unescape(self.words(n))
        self.wanted.add(text)
        return html.escape(text, quote=False)

    def page(self) -> str:
        rng = self.rng
        if rng.random() < 0.1:
            return self.bare()
        before = [k for k, p in (("header", 0.5), ("nav", 0.6), ("notice", 0.25), ("ad", 0.4), ("form", 0.15), ("side", 0.12)) if rng.random() < p]
        after = [k for k, p in (("related", 0.25), ("comments", 0.3), ("side", 0.3), ("ad", 0.15), ("form", 0.15), ("share", 0.15), ("footer", 0.8)) if rng.random() < p]
        if rng.random() < 0.2:
            rng.shuffle(before)
        if rng.random() < 0.06:
            before.insert(0, "noscript")
        body = "".join(map(self.boilerplate, before)) + self.article() + "".join(map(self.boilerplate, after))
        for _ in range(rng.choice([0, 0, 1, 2])):
            body = f"<div{self.attrs('wrap')}>{body}</div>"
        head = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{self.words(4)}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
        return head + body + ("</body></html>" if rng.random() < 0.9 else "")


def compose(n: int, seed: int) -> list[tuple[str, frozenset[str]]]:
    """``n`` pages with the texts of their articles' blocks."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        page = Page(rng)
        text = page.page()
        out.append((text, frozenset(page.wanted)))
    return out
