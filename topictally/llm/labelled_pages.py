"""Labelled pages: layouts of many kinds, whose main elements carry a label.

The layouts are written by hand and combined at random, with a fixed seed. Words are made of random
letters, since the model looks at the shape of a page and not at its words. The number of pages is
fixed.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

#: Class word of elements that belong to the article, and name of elements around text without a tag.
LABEL = "labelledmain"
PAGES = 400

NAVIGATION = (
    "<nav><ul>{links}</ul></nav>",
    "<nav class='main-nav'>{plain_links}</nav>",
    "<div class='menu'><ul>{links}</ul></div>",
    "<ul id='nav'>{links}</ul>",
    "<div id='navigation'>{plain_links}</div>",
    "<div class='breadcrumb'>{plain_links}</div>",
    "<div role='navigation'><ul>{links}</ul></div>",
)
HEADERS = (
    "<header><h1>{short}</h1><p>{line}</p></header>",
    "<header><a href='/'>{short}</a></header>",
    "<div id='header'><div class='logo'>{short}</div></div>",
    "<div class='masthead top'><h2>{short}</h2><p>{line}</p></div>",
    "<div role='banner'>{line}</div>",
)
NOTICES = (
    "<div class='cookie-notice'><p>{line}</p><button>{short}</button></div>",
    "<div id='cookie-banner'>{line} <a href='/c'>{short}</a></div>",
    "<div class='notice'>{line}</div>",
    "<div class='alert alert-info'><p>{line}</p></div>",
    "<div class='newsletter subscribe'><h3>{short}</h3><p>{line}</p><form><input><button>{short}</button></form></div>",
    "<div class='popup modal'><p>{long}</p></div>",
    "<div class='consent gdpr'><p>{line}</p></div>",
)
ADVERTS = (
    "<div class='ad'>{line}</div>",
    "<div class='ads'><p>{long}</p></div>",
    "<div class='advert'><a href='/x'>{line}</a></div>",
    "<div class='advertisement'><p>{line}</p></div>",
    "<aside class='promo'><p>{line}</p></aside>",
    "<div class='sponsored'><h3>{short}</h3><p>{long}</p></div>",
    "<div id='banner-ad'>{line}</div>",
)
SIDEBARS = (
    "<aside><h3>{short}</h3><p>{long}</p></aside>",
    "<div class='sidebar'><h3>{short}</h3><ul>{links}</ul><p>{line}</p></div>",
    "<div id='sidebar'><div class='widget'><h4>{short}</h4><p>{long}</p></div></div>",
    "<div class='related'><h3>{short}</h3><ul>{links}</ul></div>",
    "<div role='complementary'><p>{line}</p></div>",
)
FORMS = (
    "<form><label>{short}</label><input><button>{short}</button></form>",
    "<form class='search'><label>{line}</label><select><option>{short}</select><input type=submit></form>",
    "<div class='contact'><form><fieldset><legend>{short}</legend><p>{line}</p><textarea>{short}</textarea></fieldset></form></div>",
)
COMMENTS = (
    "<section class='comments'><h2>{short}</h2><div class='comment'><p>{long}</p></div><div class='comment'><p>{line}</p><p>{long}</p></div></section>",
    "<div id='comments'><h3>{short}</h3><ol><li class='comment'><b>{short}</b><p>{long}</p></li><li class='comment'><p>{line}</p></li></ol></div>",
    "<div class='comment-list'><article class='comment'><p>{long}</p></article><article class='comment'><p>{line}</p></article></div>",
    "<section id='discussion' class='responses'><p>{long}</p><p>{line}</p></section>",
    "<div class='reply'><p>{line}</p></div>",
)
FOOTERS = (
    "<footer>© {line}</footer>",
    "<footer><p>{long}</p><p>&copy; {short}</p></footer>",
    "<div id='footer'><ul>{links}</ul><p>&copy; {line}</p></div>",
    "<div class='footer'><p>{line}</p></div>",
    "<div role='contentinfo'>{line}</div>",
    "<div class='copyright'>&copy; {short}</div>",
)
SHARING = (
    "<div class='share'><a href='/s'>{short}</a> <a href='/t'>{short}</a></div>",
    "<ul class='social'>{links}</ul>",
    "<div class='tags'>{plain_links}</div>",
    "<div class='pagination'>{plain_links}</div>",
)
CONTAINERS = (
    "<article>{body}</article>",
    "<article class='post'>{body}</article>",
    "<main>{body}</main>",
    "<main><article>{body}</article></main>",
    "<main id='main'><div class='content'>{body}</div></main>",
    "<div id='content'>{body}</div>",
    "<div class='content'><div class='entry-content'>{body}</div></div>",
    "<div class='article-body'>{body}</div>",
    "<section class='story'>{body}</section>",
    "<div class='post'><div class='text'>{body}</div></div>",
    "<div role='main'>{body}</div>",
    "<div class='page'>{body}</div>",
    "<div>{body}</div>",
    "<div><div>{body}</div></div>",
    "<div><div><div>{body}</div></div></div>",
    "{body}",
    "{body}",
)
#: Parts of an article; {m} is the label.
PARTS = (
    "<p {m}>{long}</p>",
    "<p {m}>{long}</p>",
    "<p {m}>{long}</p>",
    "<p {m}>{line}</p>",
    "<p {m}>{word}</p>",
    "<p {m}><b>{line}<br></p>",
    "<p {m}>{long} <a href='/r'>{short}</a> {line}</p>",
    "<h2 {m}>{short}</h2>",
    "<h3 {m}>{short}</h3>",
    "<ul {m}><li>{line}</li><li>{line}</li><li>{short}</li></ul>",
    "<ol {m}><li>{line}</li><li>{long}</li></ol>",
    "<blockquote {m}><p>{long}</p></blockquote>",
    "<blockquote {m}>{line}</blockquote>",
    "<pre {m}>{line}</pre>",
    "<table {m}><tr><th>{short}</th><td>{short}</td></tr><tr><td>{word}</td><td>{line}</td></tr></table>",
    "<dl {m}><dt>{short}</dt><dd>{line}</dd></dl>",
    "<figure {m}><img src='x'><figcaption>{line}</figcaption></figure>",
    "<div {m}>{long}</div>",
    "<section {m}><h2>{short}</h2><p>{long}</p></section>",
    "<div {m}><p>{long}</p><p>{line}</p></div>",
    f"<{LABEL}>{{long}}</{LABEL}>",
)
#: Pages of a single block.
LONE = (
    f"<{LABEL}>{{long}}</{LABEL}>",
    f"<{LABEL}>{{line}}</{LABEL}>",
    "<p {m}>{long}</p>",
    "<p {m}>{line}</p>",
    "<div><p {m}>{line}</p></div>",
    "<div {m}>{line}</div>",
)
TITLES = (
    "<h1 {m}>{title}</h1>",
    "<h1 {m}>{title}</h1>",
    "<h2 {m}>{title}</h2>",
    "<header><h1 {m}>{title}</h1></header>",
)


class Layouts:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, least: int, most: int) -> str:
        letters = "abcdefghijklmnoprstuvwzéüñ"
        pick = self.random
        return " ".join(
            "".join(pick.choice(letters) for _ in range(pick.randint(1, 9)))
            for _ in range(pick.randint(least, most))
        )

    def fill(self, layout: str, mark: str = "", body: str = "") -> str:
        links = "".join(f"<li><a href='/l'>{self.words(1, 3)}</a></li>" for _ in range(4))
        plain = " | ".join(f"<a href='/l'>{self.words(1, 2)}</a>" for _ in range(4))
        end = self.random.choice([".", ".", "", "!", "###"])
        return layout.format(
            links=links,
            plain_links=plain,
            short=self.words(1, 4),
            word=self.words(1, 1) + end,
            title=self.words(1, 25) + end,
            line=self.words(3, 14) + end,
            long=self.words(12, 90) + end,
            m=mark,
            body=body,
        )

    def some(self, layouts: tuple[str, ...], chance: float) -> list[str]:
        if self.random.random() > chance:
            return []
        return [self.fill(self.random.choice(layouts))]

    def page(self) -> str:
        mark = f"class='{LABEL}'"
        if self.random.random() < 0.15:
            lone = self.fill(self.random.choice(LONE), mark)
            return lone if self.random.random() < 0.5 else f"<html><body>{lone}</body></html>"
        inside = []
        if self.random.random() < 0.7:
            inside.append(self.fill(self.random.choice(TITLES), mark))
        for _ in range(self.random.randint(0 if inside else 1, 12)):
            inside.append(self.fill(self.random.choice(PARTS), mark))
            for layouts in (ADVERTS, SIDEBARS, SHARING, NOTICES, FORMS):
                inside += self.some(layouts, 0.04)
        inside += self.some(SHARING, 0.2) + self.some(COMMENTS, 0.25)
        container = self.random.choice(CONTAINERS).replace("{body}", "".join(inside))
        before = [
            *self.some(NOTICES, 0.4),
            *self.some(HEADERS, 0.5),
            *self.some(NAVIGATION, 0.8),
            *self.some(FORMS, 0.2),
            *self.some(ADVERTS, 0.5),
        ]
        after = [
            *self.some(ADVERTS, 0.3),
            *self.some(SIDEBARS, 0.5),
            *self.some(COMMENTS, 0.4),
            *self.some(NOTICES, 0.2),
            *self.some(FOOTERS, 0.9),
        ]
        if self.random.random() < 0.3:
            before, after = before[:-1], before[-1:] + after
        if self.random.random() < 0.2:
            before, after = [], []
        body = "".join([*before, container, *after])
        if self.random.random() < 0.3:
            body = f"<div class='wrapper'>{body}</div>"
        if self.random.random() < 0.1:
            return body
        return f"<html><head><title>{self.words(1, 6)}</title></head><body>{body}</body></html>"


def labelled_pages(pages: int = PAGES, seed: int = 11) -> Iterator[str]:
    layouts = Layouts(seed)
    for _ in range(pages):
        yield layouts.page()
