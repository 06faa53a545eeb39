"""A seeded grammar of web pages whose blocks are known to be article or not: the training data of
the block labeller. Its tag, class and phrase lists are ordinary web usage; words are syllables at
random, so that the labeller has to learn markup, place and context more than vocabulary."""

from __future__ import annotations

import random

# Names that mark up each part of a page, as class or id.
NAMES = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs mainmenu subnav pagination pager toc links skip",
    "header": "header masthead banner top site logo branding tagline topbar head",
    "footer": "footer bottom copyright colophon foot legal credits imprint",
    "sidebar": "sidebar widget related recommended popular rail tags trending aside secondary more also archive",
    "notice": "cookie cookies consent notice gdpr alert popup modal newsletter subscribe paywall overlay message disclaimer",
    "advert": "ad ads advert advertisement sponsored promo sponsor adslot adsense teaser promotion commercial",
    "form": "form search login signup contact register feedback poll survey",
    "comments": "comments comment commentlist disqus replies reply responses discussion reactions respond reader",
    "share": "share social sharing follow buttons tools print toolbar",
}
CONTENT = "content main post entry article story body text page primary postcontent entrycontent articlebody prose detail"
# What the parts often say.
PHRASES = {
    "menu": "home;about us;contact;news;products;services;blog;login;sitemap;next page;previous;back to top;skip to content",
    "header": "welcome;your daily source;sign in;call us today;free shipping;breaking news;menu",
    "footer": "© 2021 all rights reserved;privacy policy;terms of use;copyright 2019;imprint;powered by;contact us;© 2024 ·",
    "sidebar": "related articles;most popular;read also;tags;categories;recent posts;archives;you may also like;follow us",
    "notice": "this site uses cookies;accept all;we value your privacy;subscribe to our newsletter;javascript is disabled;got it",
    "advert": "advertisement;sponsored;buy now;special offer;limited time only;click here;shop now;best price",
    "form": "your email;search;submit;name;password;send message;required field;remember me;post comment",
    "comments": "3 comments;reply;leave a comment;says:;great post;i agree with this;thanks for sharing;log in to reply;posted by",
    "share": "share on facebook;tweet;email this;print;share this;pin it;whatsapp",
}
TAG = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
_SOUNDS = (
    "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve",
    "en er ch ei de ie in te ge un ver sch ung keit ö ü ä ß zu be au lich heit pf",
    "es le de en re nt on er ent qu é è ou ai tion eau que la ment pa vi ç",
    "de en la os ar ue ra ción ado as ñ í ó ta co el mente que do ja",
)


class Grammar:
    """Pages at random; :meth:`page` gives html in which block texts begin with a mark that tells
    their class, and the marks are taken off by the trainer."""

    KEEP, DROP = "\ue000", "\ue001"

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(self.sounds) for _ in range(self.r.choice((1, 1, 2, 2, 3, 3, 4))))

    def prose(self, low: int, high: int) -> str:
        n = self.r.randint(low, high)
        words = [self.word() for _ in range(n)]
        if self.r.random() < 0.08:
            words = [w + self.r.choice((" |", "!!", "###")) for w in words]
        for k in range(0, n, self.r.randint(4, 14)):
            words[k] = words[k].capitalize()
            if k:
                words[k - 1] += self.r.choice(".,.?")
        out = " ".join(words) + self.r.choice((".", ".", ".", "", "!", "?", ":"))
        if self.r.random() < 0.1:
            out = out.replace(" ", f" <a href='/x'>{self.word()}</a> ", 1)
        if self.r.random() < 0.1:
            out = out.replace(" ", f" <b>{self.word()}</b> ", 1)
        return out

    def attribute(self, names: str) -> str:
        roll, name = self.r.random(), self.r.choice(names.split())
        if roll < 0.15:
            name = self.r.choice(("site-", "page-", "block-", "l-", "js-", "region-")) + name
        elif roll < 0.3:
            name += self.r.choice(("-wrapper", "-list", "-box", "-area", "-1", "-inner", "-item", "-container"))
        kind = self.r.choice(("class", "class", "id"))
        extra = f" class='{self.word()}'" if kind == "id" and self.r.random() < 0.2 else ""
        return f' {kind}="{name}"{extra}'

    def other_text(self, role: str) -> str:
        roll = self.r.random()
        if roll < 0.35:
            return self.r.choice(PHRASES[role].split(";"))
        if roll < 0.5:
            return f"{self.r.choice(PHRASES[role].split(';'))} {self.prose(2, 12)}"
        return self.prose(3, 60) if role in ("comments", "notice", "advert", "footer", "sidebar") else self.prose(1, 5)

    def other(self, role: str, inside: bool = False) -> str:
        """A part that is no article."""
        tag = TAG.get(role, "div")
        if tag == "div" or self.r.random() < 0.4 or (inside and tag == "header"):
            tag = self.r.choice(("div", "div", "div", "section", "ul" if role == "menu" else "div"))
            if tag == "ul":
                items = "".join(f"<li><a href='/a'>{self.DROP}{self.other_text(role)}</a></li>" for _ in range(self.r.randint(2, 8)))
                return f"<ul{self.attribute(NAMES[role])}>{items}</ul>"
            open_ = f"<{tag}{self.attribute(NAMES[role])}>"
        else:
            open_ = f"<{tag}{self.attribute(NAMES[role]) if self.r.random() < 0.5 else ''}>"
        body = []
        for _ in range(self.r.randint(1, 5 if role in ("sidebar", "comments", "form") else 2)):
            text, kind = self.DROP + self.other_text(role), self.r.random()
            if role in ("menu", "share") or kind < 0.2:
                body.append("<ul>" + "".join(f"<li><a href='/b'>{self.DROP}{self.other_text(role)}</a></li>" for _ in range(self.r.randint(2, 7))) + "</ul>")
            elif role == "form":
                body.append(f"<label>{text}</label><input name=q><button>{self.other_text(role)}</button>")
            elif kind < 0.55:
                body.append(f"<p>{text}</p>")
            elif kind < 0.7:
                body.append(f"<div{self.attribute(NAMES[role])}>{text}</div>")
            elif kind < 0.8:
                body.append(f"<h3>{text}</h3>")
            else:
                body.append(text + "<br>")
        return f"{open_}{''.join(body)}</{tag}>"

    def article(self) -> str:
        r, out = self.r, []
        if r.random() < 0.85:
            head = f"<h1>{self.KEEP}{self.prose(2, 12)}</h1>"
            out.append(f"<header>{head}</header>" if r.random() < 0.07 else head)
        for _ in range(r.choice((1, 1, 2, 3, 4, 5, 6, 8, 12, 20, 45))):
            kind, text = r.random(), self.KEEP + self.prose(1, 90 if r.random() < 0.6 else 4)
            if kind < 0.6:
                out.append(f"<p>{text}</p>")
            elif kind < 0.72:
                out.append(f"<p>{'<b>' if r.random() < 0.7 else ''}{text}{'<br>' if r.random() < 0.7 else ''}")
            elif kind < 0.8:
                out.append(f"<h{r.randint(2, 4)}>{self.KEEP}{self.prose(1, 8)}</h2>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{self.KEEP}{self.prose(1, 15)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.9:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.92:
                out.append(f"<table><tr><td>{text}</td><td>{self.KEEP}{self.prose(1, 4)}</td></tr></table>")
            elif kind < 0.94:
                out.append(f"<pre>{text}</pre>")
            elif kind < 0.96:
                out.append(f"<div>{text}</div>")
            else:
                out.append(self.other(r.choice(("advert", "sidebar", "share", "notice", "form", "comments")), inside=True))
        if r.random() < 0.1:
            out.append(self.other("comments", inside=True))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        self.sounds = r.choice(_SOUNDS).split()
        before = [role for role, p in (("notice", 0.2), ("header", 0.4), ("menu", 0.75), ("form", 0.12), ("advert", 0.4)) if r.random() < p]
        after = [
            role
            for role, p in (("share", 0.2), ("comments", 0.35), ("advert", 0.15), ("sidebar", 0.35), ("form", 0.2), ("notice", 0.12), ("footer", 0.8))
            if r.random() < p
        ]
        if r.random() < 0.3:
            before.append("sidebar")
        if r.random() < 0.3:
            r.shuffle(before)
        shape = r.random()
        inner = self.article()
        if shape < 0.5:
            inner = f"<article{self.attribute(CONTENT) if r.random() < 0.3 else ''}>{inner}</article>"
        elif shape < 0.62:
            inner = f"<main>{inner}</main>"
        elif shape < 0.9:
            inner = f"<div{self.attribute(CONTENT)}>{inner}</div>"
        if r.random() < 0.2:
            inner = f"<div{self.attribute(CONTENT + ' wrapper container row column')}>{inner}</div>"
        body = "".join(map(self.other, before)) + inner + "".join(map(self.other, after))
        if r.random() < 0.15:
            body = f"<div class='{r.choice(('wrapper', 'container', 'page', 'outer'))}'>{body}</div>"
        return f"<html><body>{body}</body></html>" if r.random() < 0.9 else f"<html><body>{body}"
