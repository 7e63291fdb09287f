"""Labelled pages put together from parts; ``data-main`` marks what is content."""

from __future__ import annotations

import random

_SYLLABLES = "ka lo mi ren tas vo du sel pi nor gat em ul wir hos".split()


class _Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def word(self) -> str:
        return "".join(self.random.choices(_SYLLABLES, k=self.random.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.random.randint(low, high)))

    def sentence(self) -> str:
        text = self.words(3, 14).capitalize()
        return text.replace(" ", ", ", 1) + self.random.choice([".", ".", "!", "?", ""])

    def passage(self, low: int = 1, high: int = 9) -> str:
        return " ".join(self.sentence() for _ in range(self.random.randint(low, high)))

    def pick(self, *options: str) -> str:
        return self.random.choice(options)

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/{self.word()}">{self.words(1, 3)}</a></li>' for _ in range(self.random.randint(low, high)))

    def heading(self) -> str:
        return f"<{(t := self.pick('h2', 'h3', 'h4'))}>{self.words(1, 3)}</{t}>"

    def menu(self) -> str:
        inner = f"<ul>{self.links(3, 9)}</ul>"
        return self.pick(f"<nav>{inner}</nav>", f'<div class="menu">{inner}</div>', f'<div id="navbar">{inner}</div>', f'<ul class="breadcrumb">{self.links(2, 4)}</ul>')

    def header(self) -> str:
        inner = f"<h1><a href='/'>{self.words(1, 3)}</a></h1>" if self.random.random() < 0.5 else f"<div>{self.words(1, 6)}</div>"
        return self.pick(f"<header>{inner}{self.menu()}</header>", f'<div class="site-header">{inner}<p>{self.words(2, 7)}</p></div>')

    def advert(self) -> str:
        text = self.sentence() if self.random.random() < 0.7 else f'<p>{self.sentence()} <a href="#">{self.words(1, 3)}</a></p>'
        return self.pick(f'<div class="ad">{text}</div>', f'<div class="advert-box">{text}</div>', f'<aside class="sponsored">{text}</aside>', f'<section id="ads"><p>{self.passage(1, 2)}</p></section>')

    def notice(self) -> str:
        text = f"<p>{self.passage(1, 3)}</p><button>{self.word()}</button>"
        return self.pick(f'<div class="cookie-notice">{text}</div>', f'<div id="consent" role="dialog">{text}</div>', f'<div class="alert">{self.sentence()}</div>')

    def side(self) -> str:
        text = f"{self.heading()}<ul>{self.links(2, 7)}</ul><p>{self.passage(1, 2)}</p>"
        text = self.pick(text, text, f"{self.heading()}<p>{self.passage(1, 3)}</p>")
        return self.pick(f"<aside>{text}</aside>", f'<div class="sidebar">{text}</div>', f'<div id="widget-area">{text}</div>')

    def related(self) -> str:
        return f'<div class="{self.pick("related", "share-links", "more popular", "tags")}">{self.heading()}<ul>{self.links(2, 6)}</ul></div>'

    def comments(self) -> str:
        one = lambda: f'<div class="{self.pick("comment", "reply", "comment-body")}"><b>{self.word()}</b><p>{self.passage(1, 4)}</p></div>'
        inner = self.heading() + "".join(one() for _ in range(self.random.randint(1, 5)))
        plain = self.heading() + f"<p>{self.passage(1, 4)}</p>" * self.random.randint(1, 4)
        if self.random.random() < 0.3:
            return f'<{(t := self.pick("section", "div"))} class="{self.pick("comments", "reader-comments", "discussion", "replies")}">{plain}</{t}>'
        return self.pick(f'<section id="comments">{inner}</section>', f'<div class="comments">{inner}</div>', f'<ol class="reader-comments"><li><p>{self.passage(1, 4)}</p></li><li>{self.passage(1, 3)}</li></ol>')

    def form(self) -> str:
        return self.pick(
            f'<form action="/s"><label>{self.words(1, 4)}</label><input name="q"><button>{self.word()}</button></form>',
            f'<div class="newsletter"><p>{self.sentence()}</p><form><input><button>{self.word()}</button></form></div>',
            f'<form class="login"><p>{self.passage(1, 2)}</p><select><option>{self.word()}</select></form>',
        )

    def footer(self) -> str:
        text = f"&copy; {self.words(1, 3)} &middot; {self.passage(1, 2)}"
        return self.pick(f"<footer>{text}</footer>", f'<div class="footer"><p>{text}</p></div>', f"<footer><p>{text}</p><ul>{self.links(2, 5)}</ul></footer>")

    def inline(self) -> str:
        return f'{self.passage(1, 3)} <{"%s>%s</%s" % ((t := self.pick("b", "em", "strong", "code")), self.words(1, 3), t)} <a href="#">{self.words(1, 3)}</a> {self.passage(1, 3)}'

    def paragraph(self) -> str:
        return self.pick(
            *[f"<p>{self.passage()}</p>"] * 4,
            f"<p>{self.inline()}</p>",
            f"<p><b>{self.passage(1, 3)}<br><p>{self.passage()}</p>",
            f"<p>{self.words(1, 6)}",
            f"<h2>{self.words(2, 6)}</h2><p>{self.passage()}</p>",
            f"<ul><li>{self.passage(1, 2)}</li><li>{self.inline()}</li><li>{self.words(1, 5)}</li></ul>",
            f"<blockquote>{self.passage(1, 4)}</blockquote>",
            f"<pre>{self.words(2, 12)}</pre>",
            f"<table><tr><td>{self.words(1, 3)}<td>{self.words(1, 4)}</tr></table>",
            f"<p>{' | '.join(self.words(1, 2) for _ in range(12))}</p>",
            f"<p>{(self.word() + ' ') * 30}</p>",
            f"<div>{self.passage()}</div>",
        )

    def article(self) -> str:
        parts = [self.paragraph() for _ in range(self.random.choice([1, 1, 2, 3, 5, 8]))]
        if self.random.random() < 0.05:
            parts = [f"<p>{self.passage(1, 3)}</p>" for _ in range(self.random.randint(40, 150))]
        if self.random.random() < 0.15:
            parts = [f"<p>{self.words(1, 4)}.</p>"]
        if self.random.random() < 0.6:
            parts.insert(0, f"<h1>{self.words(2, 9)}</h1>")
        for part in (self.advert, self.related, self.form, self.comments, self.notice):
            if self.random.random() < 0.25:
                parts.insert(self.random.randint(1, len(parts)), f'<div data-main="0">{part()}</div>' if self.random.random() < 0.2 else part().replace(">", ' data-main="0">', 1))
        inner = "".join(parts)
        if self.random.random() < 0.1:  # no element around it
            return "".join(p if "data-main" in p else p.replace(">", ' data-main="1">', 1) for p in parts)
        return self.pick(
            *[f'<article data-main="1">{inner}</article>'] * 3,
            f'<main data-main="1">{inner}</main>',
            f'<div class="content" data-main="1">{inner}</div>',
            f'<div id="story" data-main="1">{inner}</div>',
            f'<div class="post-body" data-main="1"><section>{inner}</section></div>',
            f'<div data-main="1">{inner}</div>',
        )

    def page(self) -> str:
        def some(*parts) -> str:
            return "".join(p() for p in parts if self.random.random() < 0.45)

        before = some(self.notice, self.header, self.menu, self.advert, self.form)
        after = some(self.side, self.advert, self.related, self.comments, self.form, self.notice, self.footer, self.footer)
        article = self.article() if self.random.random() < 0.97 else ""
        if self.random.random() < 0.3:
            article = f'<div class="{self.pick("wrapper", "page", "row", "container")}">{article}{some(self.side, self.comments)}</div>'
        tail = self.pick("</body></html>", "")
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{before}{article}{after}{tail}"


def built_pages(pages: int = 400) -> list[tuple[str, None]]:
    """The same pages in every run."""
    return [(_Writer(seed).page(), None) for seed in range(pages)]
