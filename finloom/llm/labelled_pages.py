"""Labelled pages for the extraction model: layouts written down as paths, filled with made-up prose and with boilerplate phrases.

A path is read from the outside in: tag, .class and #id. MAIN paths hold main text, OTHER paths what surrounds it. On half of the
pages the paths tell; there short and long texts, with and without full stops, occur under all of them. On the others the
names of classes are made up and only the text can tell: prose in sentences against short linked lines and boilerplate phrases.
"""

from __future__ import annotations

import random
import re

MAIN = """
article/p article/p article/p article/h1 article/h2 article/h3 article/ul/li article/ol/li article/blockquote/p article/div/p
article/section/p article/section/h2 article/table/tr/td article/pre article/figure/figcaption article/header/h1 article/dl/dd
article/div.content/p article/div.body/p main/p main/h1 main/h2 main/section/p main/div/p main/div.content/p main/article/p
main/ul/li main/blockquote/p main/table/tr/td div.content/p div.content/h1 div.post/p div.post/h1 div.entry/p div.entry-content/p
div.article-body/p div.article/p div.article/h1 div#content/p div#content/h1 div#main/p div#main/h2 div.text/p div.story/p div.main-content/p
section/p section/h2 div/p div/h1
""".split()
OTHER = """
nav/ul/li/a nav/a nav/p header/p header/h1 header/a header/div.logo header/nav/ul/li/a footer/p footer footer/ul/li/a footer/div/p footer/a
aside/p aside/h2 aside/ul/li/a aside.sidebar/p div.sidebar/p div#sidebar/ul/li div.ad div.ad/p div.ads/p div.advert/p div.advertisement
div#ad/p article/div.ad article/div.ad/p article/aside/p article/div.advert/p main/div.ad main/div.sidebar/p main/aside/p
div.cookie/p div.cookie-notice/p div.notice div.notice/p div.notice/a div#cookie/p div.consent/p div.banner/p div.alert/p section.notice/p
div.gdpr/p div#privacy-bar/p div.bottom-bar/p div.top-bar/a div.colophon/p div.masthead/a div.toolbar/a div.pagination/a
form/p form/label form/button form/div/label article/form/label article/form/p main/form/p form/select/option form/textarea form/fieldset/legend
section.comments/p section.comments/div.comment/p section.comments/h2 div.comments/p div#comments/div.comment/p div.comment/p article/section.comments/p article/div.comments/div.comment/p
article/section#comments/article.comment/p main/section.comments/div/p ol.comment-list/li/p ul.comments/li div.comment-body/p
div.respond/p div.respond/div/p div.replies/div.reply/p div.discussion/div/p div.responses/p section.feedback/p
div.menu/ul/li/a ul.menu/li/a div#menu/a div.nav/a div.navbar/ul/li div.header/p div.header/h1 div#header/p div.footer/p div#footer/p
div.share/a div.social/a article/div.share/a div.related/ul/li/a article/div.related/a div.promo/p div.newsletter/p article/div.newsletter/p div.breadcrumb/a
div.breadcrumbs/a div.sponsored/p div.popup/p div.subscribe/p div.widget/p div.disclaimer/p div.copyright button article/footer/p article/nav/a main/nav/a main/footer/p
""".split()
#: What surrounds articles says such things.
PHRASES = """
All rights reserved.|Copyright 2024 by the publisher. All rights reserved.|Terms of use and privacy policy|Contact us|About us|Imprint
We use cookies to improve your experience.|This site uses cookies. Accept all cookies or manage your consent settings.|Accept cookies
By using this website you agree to our cookie and privacy policy.|Subscribe to our newsletter|Sign up for free updates by email
Log in|Register|Search|Home|Next page|Previous page|Back to top|Skip to content|Read more|Show more|Share on social media|Follow us
Advertisement|Sponsored|Buy now and save|Shop our sale today, limited offer!|Click here for a free trial|Download our app
Related articles|You may also like|Most popular|Recommended for you|Latest news|Tags|Categories|Archive|Sitemap|Menu
Leave a comment|Reply|Comments closed|Post a comment|Report this comment|Your email address will not be published.|Anna says:
Great post, thanks for sharing!|I totally agree with this comment.|Thanks, this was helpful.|Nice article, but I disagree with you.
Impressum und Datenschutz|Alle Rechte vorbehalten.|Diese Seite verwendet Cookies.|Newsletter abonnieren|Anmelden|Kommentare|Anzeige
Mentions et politique de confidentialité|Tous droits réservés.|Ce site utilise des cookies.|Publicité|Commentaires|Connexion|Accueil
Aviso legal y privacidad|Todos los derechos reservados.|Este sitio utiliza cookies.|Suscribirse|Comentarios|Publicidad|Inicio
""".replace("\n", "|").strip("|").split("|")
#: The words of these phrases that prose has no need of.
COMMON = set("a all and are be but by des die et for from here i la las los me most more not of on our page site that the this to top una une use und utiliza utilise verwendet was we will with y you your".split())
CUES = frozenset(w for p in PHRASES for w in re.findall("[a-z]+", p.lower()) if len(w) > 2 and w not in COMMON)
SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi wo xu za schen tion ment keit".split()


def _word(r: random.Random) -> str:
    return "".join(r.choices(SYLLABLES, k=r.randint(1, 4)))


def _words(r: random.Random, n: int) -> str:
    words = [_word(r) for _ in range(n)]
    if r.random() < 0.15:  # prose may mention such things too
        words[r.randrange(n)] = r.choice(sorted(CUES))
    return " ".join(words).capitalize()


def _any(r: random.Random) -> str:
    return _words(r, r.choice((1, 1, 2, 3, 5, 9, 15, 30, 60))) + r.choice((".", ".", ".", "", "!", "***"))


def _prose(r: random.Random) -> str:
    return " ".join(_words(r, r.randint(5, 16)) + r.choice(".....?!") for _ in range(r.randint(1, 6)))


def _boilerplate(r: random.Random) -> str:
    kind = r.random()
    if kind < 0.55:
        text = r.choice(PHRASES)
        return f"<a href=/>{text}</a>" if r.random() < 0.4 else text
    if kind < 0.85:
        return f"<a href=/>{_words(r, r.randint(1, 5))}</a>"
    return f"&copy; {_words(r, r.randint(1, 4))}"


def _element(step: str, inner: str) -> str:
    for mark, name in ((".", "class"), ("#", "id")):
        if mark in step:
            tag, _, value = step.partition(mark)
            return f'<{tag} {name}="{value}">{inner}</{tag}>'
    return f"<{step}>{inner}</{step}>"


def _path(path: str, inner: str) -> str:
    for step in reversed(path.split("/")):
        inner = _element(step, inner)
    return inner


def _named_layout(r: random.Random) -> list[tuple[str, int]]:
    """Where a block stands tells what it is."""
    other = lambda: (_path(r.choice(OTHER), _boilerplate(r) if r.random() < 0.4 else _any(r)), 0)
    plan = [other() for _ in range(r.randint(0, 4))]
    root = r.choice(MAIN).split("/")[0]
    places = [p for p in MAIN if p.split("/")[0] == root]  # a page keeps to one place for its main text
    inside = [o for o in OTHER if o.startswith(("article", "main", "div.ad", "aside", "form"))]
    for _ in range(r.randint(0, 9)):
        plan.append((_path(r.choice(places), _any(r) if r.random() < 0.7 else _prose(r)), 1))
        if r.random() < 0.12:
            plan.append((_path(r.choice(inside), _any(r)), 0))
    return plan + [other() for _ in range(r.randint(0, 4))]


def _unnamed_layout(r: random.Random) -> list[tuple[str, int]]:
    """Classes mean nothing; prose is main text, with headings before it."""
    wrap = lambda inner, tags: "".join((f'<{(t := r.choice(tags))} class="{_word(r)}">', inner, f"</{t}>"))
    outer = ["div", "div", "section"]
    around = ["div/p", "div/div", "section/p", "div/span", "ul/li", "table/tr/td", "div", "div/table/tr/td"]
    other = lambda: (_path(r.choice(around), _boilerplate(r)) if r.random() < 0.5 else wrap(wrap(_boilerplate(r), ["p", "div", "span", "li"]), outer), 0)
    plan = [other() for _ in range(r.randint(0, 5))]
    if r.random() < 0.8:
        plan.append((wrap(f"<h1>{_words(r, r.randint(2, 8))}</h1>", outer), 1))
        for _ in range(r.randint(1, 8)):
            if r.random() < 0.15:
                plan.append((wrap(f"<h2>{_words(r, r.randint(1, 5))}</h2>", outer), 1))
            plan.append((wrap(f"<p>{_prose(r)}</p>", outer), 1))
            if r.random() < 0.08:
                plan.append(other())
    return plan + [other() for _ in range(r.randint(0, 6))]


def labelled_pages(n: int = 400, seed: int = 5) -> list[tuple[str, list[int]]]:
    """(html, label of each block with text in page order)."""
    r, out = random.Random(seed), []
    for i in range(n):
        plan = _unnamed_layout(r) if i % 5 < 2 else _named_layout(r)
        out.append((f"<html><head><title>x</title></head><body>{''.join(html for html, _ in plan)}</body></html>", [label for _, label in plan]))
    return out
