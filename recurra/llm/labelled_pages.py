"""Labelled pages on which the content model is trained.

An element with the attribute ``keep`` and all below it is content, unless an element
below says ``drop``; all else is not. The pages are put together from the usual
layouts with the usual names of their parts.
"""

from __future__ import annotations

from collections.abc import Iterator

LONG = "The council met again in the autumn and agreed on a plan for the bridge, which had been closed since the flood, so that work can start in spring."
MIDDLE = "Nobody had expected the vote to be so close this time."
SHORT = "It rained."
# Names of parts that hold content, and of parts that do not, as sites use them.
CONTENT = "content article post entry story main body text article-body post-content entry-content story-body main-content page-content article-text blog-post rich-text".split()
NEUTRAL = "container wrapper page row col inner layout grid site app root column section".split()
OTHER = (
    "nav navbar navigation menu main-menu breadcrumb breadcrumbs header site-header masthead topbar footer site-footer bottom sidebar side aside rail widget "
    "ad ads advert advertisement ad-banner sponsored sponsor promo banner cookie cookie-notice cookie-banner consent gdpr notice alert popup modal overlay "
    "comments comment comment-list reader-comments replies respond disqus related related-posts recommended more-stories share social sharing follow tags meta "
    "newsletter subscribe signup login search search-form form pagination pager copyright legal disclaimer toolbar skip-link author-box byline-links"
).split()


def links(n: int) -> str:
    return "".join(f'<li><a href="#">Topic {i}</a></li>' for i in range(n))


def article(tag: str, name: str) -> str:
    """Body of an article: title, paragraphs, lists, a quote, a table; an aside and an advert inside it do not belong to it."""
    heading = "<h1>A bridge for the valley</h1>"
    inner = (f"<p>{LONG}</p><p>{SHORT}</p><div>{LONG}</div><h2>Costs</h2><ul><li>{MIDDLE}</li><li>Steel</li></ul><p>{MIDDLE} <a href='#'>More</a></p>"
             f"<blockquote><p>{MIDDLE}</p></blockquote><ol><li>{SHORT}</li></ol><table><tr><td>2019</td><td>{SHORT}</td></tr></table><figure><figcaption>{MIDDLE}</figcaption></figure>"
             f"<section><h3>Later</h3><p>{LONG}</p></section><pre>x = 1</pre><dl><dt>Steel</dt><dd>{MIDDLE}</dd></dl>")
    return f'<{tag} class="{name}" keep><header>{heading}</header>{inner}<aside drop><p>{MIDDLE}</p></aside><div class="ad" drop>{SHORT}</div></{tag}>' + (
        f'<{tag} class="{name}" keep>{heading}{inner}</{tag}>')


def other(tag: str, name: str, k: int) -> str:
    texts = (f"<ul>{links(4)}</ul>", f"<p>{MIDDLE}</p><p>{SHORT}</p>", f"{SHORT}", f"<div><p>{LONG}</p></div><a href='#'>Reply</a>", f"<p>{LONG}</p><h3>Also</h3>{links(2)}")
    return f'<{tag} class="{name}">{texts[k % len(texts)]}</{tag}>'


def pages() -> Iterator[str]:
    frames = ("<nav><ul>{l}</ul></nav>", "<header><a href='#'>Home</a><p>Daily news</p></header>", "<footer><p>Copyright, all rights reserved</p><ul>{l}</ul></footer>",
              "<aside><h3>Related</h3><ul>{l}</ul><p>{m}</p></aside>", "<form><label>Mail</label><p>Sign up for our letter</p><button>Send</button></form>",
              '<div role="navigation"><ul>{l}</ul></div>', '<div role="dialog"><p>{m}</p></div>', '<div role="contentinfo"><p>{m}</p></div>', "<dialog><p>{m}</p></dialog>", '<div hidden><p>{m}</p></div>')
    frames = [f.format(l=links(4), m=MIDDLE) for f in frames]
    k = 0
    for i, name in enumerate(CONTENT):
        for tag in ("article", "div", "main", "section"):
            around = [other(("div", "section", "div", "ul")[(k + j) % 4] if j else "div", OTHER[(k * 7 + j) % len(OTHER)], k + j) for j in range(7)]
            body = article(tag, name if tag in ("div", "section") or i % 2 else "")
            if k % 3:
                inside = other("section" if k % 2 else "div", OTHER[(k * 5) % len(OTHER)], k)
                body = body.replace("</article>", f"{inside.replace('class', 'drop class', 1)}</article>", 1) if tag == "article" else body
            parts = [*frames[: 1 + k % 3], *around[:4], f'<div class="{NEUTRAL[k % len(NEUTRAL)]}" keep><div class="{NEUTRAL[(k + 3) % len(NEUTRAL)]}">{body}</div></div>' if k % 2 else body,
                     *around[4:], *frames[1 + k % 3 :]]
            yield f"<html><body>{''.join(parts)}</body></html>"
            k += 1
    for j, name in enumerate(OTHER):  # every name, before and inside an article
        for i, tag in enumerate(("div", "section", "div", "ul")):
            shell = ("article", "div", "main")[(i + j) % 3]
            inside = other(tag, name, j + i).replace("class", "drop class", 1)
            body = f'<{shell} class="{CONTENT[(i + j) % len(CONTENT)]}" keep><h1>A bridge</h1><p>{LONG}</p>{inside}<p>{SHORT}</p><p>{MIDDLE}</p></{shell}>'
            yield f"<html><body>{other(tag, name, j)}{body}{frames[(i + j) % len(frames)]}</body></html>"
    marked = [f.replace(">", " drop>", 1) for f in frames]
    plain = f"<h1>A bridge</h1><p>{LONG}</p><p>{SHORT}</p><h2>Costs</h2><p>{MIDDLE}</p><ul><li>{MIDDLE}</li><li>Steel</li></ul><p>{LONG}</p>"
    for j, name in enumerate(OTHER):  # an article without a shell of its own
        beside = other(("div", "section", "ul")[j % 3], name, j)
        yield f"<html><body keep>{marked[j % len(marked)]}{beside.replace('class', 'drop class', 1)}{plain}{marked[(j + 3) % len(marked)]}</body></html>"
        yield f"<html><body>{frames[j % len(frames)]}{beside}<div keep>{plain}</div>{frames[(j + 5) % len(frames)]}</body></html>"
