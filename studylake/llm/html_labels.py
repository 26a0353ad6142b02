"""The labelled table of the main-text classifier: invented pages, cut into labelled parts.

A page is a list of (label, markup); all text blocks of a part labelled 1 belong to the
article, those of a part labelled 0 do not.
"""

from __future__ import annotations

_LONG = "The river had risen through the night, and by the morning the lower road was gone under brown water."
_MORE = "Nobody in the village could remember a spring like it, though the old ferryman said he had seen two."
_LINKED = 'The <a href="/a">council</a> met twice that week and agreed on very little, as it had the year before.'
_SHORT = "It rained."
_ONE = "Why?"
_MENU = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "World", "Sport", "About us"))
_PLAIN_MENU = "<li>Home</li><li>World news</li><li>About</li>"

_NAV = f"<html><head><title>A flood</title></head><body><nav><ul>{_MENU}</ul></nav>"
_HEAD = f"<body><header><p>The Daily Invention</p><ul>{_MENU}</ul></header>"
_FOOT = "<footer>&copy; 2020 The Daily Invention. All rights reserved.</footer></body></html>"
_SIDE = f'<aside><h3>Most read</h3><p>{_MORE}</p><ul>{_MENU}</ul></aside>'
_AD = f'<div class="ad">{_LONG}</div>'
_SHORT_AD = '<div class="advert">Buy now.</div>'
_COOKIES = f'<div id="cookie-notice"><p>We use cookies to keep this site going. {_SHORT}</p><button>Accept all</button></div>'
_FORM = "<form action='/s'><label>Your address</label><p>Leave us your address and we write to you each week.</p></form>"
_COMMENTS = (
    f'<section class="comments"><h2>3 comments</h2><div class="comment"><p>{_MORE} I was there and saw it all.</p></div>'
    f'<article class="comment"><p>{_LONG}</p></article><div><p>{_SHORT}</p></div></section>')
_RELATED = f'<div class="related-posts"><h3>Read on</h3><p>{_LONG}</p><p><a href="/x">The old ferry</a></p></div>'
_ARTICLE = f"<h1>The flood</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_LINKED}</p><h2>After</h2><p>{_ONE}</p><ul><li>One boat</li><li>Two mules</li></ul>"
_PROSE = f"<p>{_LONG} {_MORE}</p><p>{_MORE} {_LINKED}</p><p>{_LINKED} {_LONG}</p>"
_TEASERS = "".join(f'<p><a href="/{k}">Read how the {k} bridge was built again</a></p>' for k in ("old", "new", "long"))

PAGES = [
    [(0, _NAV + _AD), (1, f"<article>{_ARTICLE}</article>"), (0, _FOOT)],
    [(0, _HEAD + _COOKIES), (1, f"<main><article>{_ARTICLE}{_PROSE}</article>"), (0, _COMMENTS + "</main>" + _SIDE + _FOOT)],
    [(0, _NAV + _SIDE), (1, f"<article><header><h1>The flood</h1><p>{_SHORT}</p></header>{_PROSE}"), (0, _AD + _SHORT_AD),
     (1, f"<p>{_ONE}</p><p>{_LONG}</p>"), (0, _FORM + _RELATED), (1, f"<p>{_SHORT}</p></article>"), (0, _COMMENTS + _FOOT)],
    [(0, _HEAD), (1, f'<div class="post-content">{_ARTICLE}</div>'), (0, _RELATED + _COMMENTS + _FOOT)],
    [(0, _COOKIES + _NAV), (1, f'<div id="content"><p>{_SHORT}</p><blockquote>{_MORE}</blockquote><p>{_ONE}</p></div>'),
     (0, f'<div class="sidebar"><p>{_LONG}</p></div>' + _FOOT)],
    [(0, f"<body><ul>{_MENU}</ul>"), (1, f"<h1>The flood of that year</h1>{_PROSE}"), (0, _TEASERS + "<p>Copyright 2020</p></body>")],
    [(0, f"<body><table><tr><td>{_MENU}</td>"), (1, f"<td>{_PROSE}</td>"), (0, f"</tr></table>{_TEASERS}")],
    [(0, f"<body><p>Home</p><p>Search</p>{_TEASERS}"), (1, _PROSE + f"<p>{_LINKED}</p>"), (0, f"<ul>{_PLAIN_MENU}</ul>" + _FORM)],
    [(0, _HEAD + _FORM + _AD), (1, f"<article><p>{_ONE}</p></article>"), (0, _AD + _SIDE + _FOOT)],
    [(0, _NAV), (1, f'<article><p>{_SHORT}</p><p>{_LINKED}</p><p><a href="/s">{_LONG}</a></p>'),
     (0, f'<footer>Filed under floods</footer><div class="share">Tell a friend about this page.</div>'), (1, f"<p>{_MORE}</p></article>"),
     (0, _COMMENTS + _RELATED + _FOOT)],
    [(0, _NAV + _SHORT_AD), (1, f"<main><h1>Opening hours</h1><table><tr><th>Monday</th><td>Nine to five</td></tr></table><p>{_ONE}</p></main>"),
     (0, f'<div class="newsletter-signup"><p>{_LONG}</p></div><div role="alert"><p>{_MORE}</p></div>' + _FOOT)],
    [(0, f'<body><div class="site-header"><p>{_MORE}</p></div><div class="menu"><p>{_SHORT}</p></div>'),
     (1, f'<div role="main">{_ARTICLE}</div>'), (0, f'<div class="footer"><p>{_LONG}</p><p>{_MORE}</p></div>')],
    [(0, f"<body><div><p>{_LONG}</p></div>"), (1, f"<article>{_ARTICLE}<p><a href='/z'>{_SHORT}</a></p></article>"),
     (0, f"<div><p>{_LONG}</p><p>{_MORE}</p><p>{_SHORT}</p></div>")],
    [(0, f"<body><p>{_MORE}</p><p>{_LINKED}</p>"),
     (1, f'<main><p><a href="/1">The first letter</a></p><p><a href="/2">{_MORE}</a></p><ul>{_MENU}</ul></main>'),
     (0, f"<p>{_LONG}</p><p>{_ONE}</p>")],
    [(0, f"<body><ul>{_MENU}</ul>"), (1, f"<h1>The flood</h1><p>{_LONG}</p><p>{_ONE}</p><p>{_MORE}</p><p>{_SHORT}</p><p>{_LINKED}</p>"),
     (0, f"<ul>{_MENU}</ul><p>Top</p>")],
    [(0, "<body><p>Skip</p>"), (1, f"<h2>Two mules</h2><p>{_MORE}</p><p>{_SHORT}</p><p>{_LONG}</p>"), (0, f"{_TEASERS}<p>Top</p><p>Print</p>")],
]
