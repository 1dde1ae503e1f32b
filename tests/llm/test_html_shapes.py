"""Hand-written pages in shapes that real sites have; no page comes from the generator that the model learns from."""

import pytest

from aqgrid.llm import html_extract as h

P = [
    "The river rose again last night, and the lower streets were closed by noon.",
    "Nobody in the council had expected the water to come back so soon after the spring.",
    "“We will need help,” the mayor said; boats had already been sent from the coast.",
]
T = "River rises again"
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul></nav>'
FOOT = "<footer><p>&copy; 2024 The Daily Paper. All rights reserved.</p><a href='/terms'>Terms</a></footer>"
ps = lambda tag="p": "".join(f"<{tag}>{x}</{tag}>" for x in P)
full = [T, *P]

PAGES = {
    "plain article": (f"<body>{NAV}<article><h1>{T}</h1>{ps()}</article>{FOOT}", full),
    "body class comments-open": (f'<body class="single comments-open">{NAV}<div><h1>{T}</h1>{ps()}</div>{FOOT}', full),
    "body class has-sidebar": (f'<body class="post-12 has-sidebar">{NAV}<div><div><h1>{T}</h1>{ps()}</div></div>{FOOT}', full),
    "body class no-sidebar": (f'<body class="no-sidebar">{NAV}<div><h1>{T}</h1>{ps()}</div>{FOOT}', full),
    "body class header-fixed": (f'<body class="header-fixed">{NAV}<article><h1>{T}</h1>{ps()}</article>{FOOT}', full),
    "wrapper with-sidebar": (f'<body><div id="wrap" class="with-sidebar">{NAV}<div><h1>{T}</h1>{ps()}</div><aside><h3>More</h3><ul><li><a href="/a">Read this</a></li></ul></aside></div>{FOOT}', full),
    "html class and wrapper": (f'<html class="cookie-ok nav-open"><body><div class="page menu-left">{NAV}<main><h1>{T}</h1>{ps()}</main></div>{FOOT}', full),
    "form around the page": (f'<body><form id="aspnetForm" action="x"><div>{NAV}<article><h1>{T}</h1>{ps()}</article>{FOOT}</div></form>', full),
    "nameless divs": (f"<body><div>{NAV}</div><div><div><h1>{T}</h1><div>{P[0]}</div><div>{P[1]}</div><div>{P[2]}</div></div></div><div>{FOOT}</div>", full),
    "linked list in the article": (f"<body>{NAV}<article><h1>{T}</h1><p>{P[0]}</p><ul><li><a href='/1'>Report of the first flood</a></li><li><a href='/2'>Map of the dams</a></li><li><a href='/3'>Numbers to call</a></li></ul><p>{P[1]}</p><p>{P[2]}</p></article>{FOOT}", [T, P[0], "Report of the first flood", "Map of the dams", "Numbers to call", P[1], P[2]]),
    "twelve links in the article": (f"<body>{NAV}<article><h1>{T}</h1><p>{P[0]}</p><ol>" + "".join(f"<li><a href='/{i}'>Street number {i}</a></li>" for i in range(12)) + f"</ol><p>{P[1]}</p></article>{FOOT}", [T, P[0], *(f"Street number {i}" for i in range(12)), P[1]]),
    "a quote to share": (f'<body>{NAV}<article><h1>{T}</h1><p>{P[0]}</p><div class="share-quote"><p>{P[2]}</p></div><p>{P[1]}</p><div class="share-buttons"><a href="#">Tweet</a> <a href="#">Mail</a></div></article>{FOOT}', [T, P[0], P[2], P[1]]),
    "blog post with entry names": (f'<body><div id="header"><h2><a href="/">My blog</a></h2></div><div class="hentry post"><h1 class="entry-title">{T}</h1><div class="entry-content">{ps()}</div></div><div id="footer"><p>Powered by some engine</p></div>', full),
    "comments under the article": (f'<body>{NAV}<article><h1>{T}</h1>{ps()}</article><section id="comments"><h2>2 comments</h2><ol><li class="comment"><p>I saw it from my window, it was dreadful.</p></li><li class="comment"><p>Thanks for the report!</p></li></ol></section>{FOOT}', full),
    "many comments, short article": (f'<body>{NAV}<article><h1>{T}</h1><p>{P[0]}</p></article><div class="comments-area"><h2>Comments</h2>' + "".join(f"<div class='comment'><p>Number {i} here, and I think that all of this was known before it happened to us.</p></div>" for i in range(15)) + f"</div>{FOOT}", [T, P[0]]),
    "related box in the article": (f'<body>{NAV}<article><h1>{T}</h1><p>{P[0]}</p><div class="related"><h3>Related</h3><ul><li><a href="/x">Old floods</a></li></ul></div><p>{P[1]}</p><p>{P[2]}</p></article>{FOOT}', full),
    "headings and a table": (f"<body>{NAV}<main><h1>{T}</h1><p>{P[0]}</p><h2>What is known</h2><table><tr><td>Level</td><td>4.2 m</td></tr></table><p>{P[1]}</p></main>{FOOT}", [T, P[0], "What is known", "Level", "4.2 m", P[1]]),
    "unclosed paragraphs": (f"<body>{NAV}<article><h1>{T}</h1><p>{P[0]}<p>{P[1]}<p>{P[2]}</article>{FOOT}", full),
    "cookie notice and newsletter": (f'<body><div class="cookie-banner"><p>We use cookies to improve this site.</p><button>Accept</button></div>{NAV}<article><h1>{T}</h1>{ps()}<div class="newsletter-signup"><p>Get our mail every morning.</p><form><input name=q><button>Go</button></form></div></article>{FOOT}', full),
    "hidden text": (f'<body>{NAV}<article><h1>{T}</h1>{ps()}<div style="display: none">Secret words for the machine.</div></article>{FOOT}', full),
    "hidden body until scripts run": (f'<body style="display:none">{NAV}<article><h1>{T}</h1>{ps()}</article>{FOOT}', full),
    "blockquote and code": (f"<body>{NAV}<article><h1>{T}</h1><p>{P[0]}</p><blockquote><p>{P[2]}</p></blockquote><pre>level = 4.2</pre></article>{FOOT}", [T, P[0], P[2], "level = 4.2"]),
    "links within the lines": (f"<body>{NAV}<article><h1>{T}</h1><p>The <a href='/r'>river</a> rose, and <a href='/c'>the council</a> met at once to talk.</p><p>{P[1]}</p></article>{FOOT}", [T, "The river rose, and the council met at once to talk.", P[1]]),
    "section with a name": (f'<body>{NAV}<section class="story-body"><h1>{T}</h1>{ps()}</section><div class="widget"><p>Weather: rain, again and again.</p></div>{FOOT}', full),
}


@pytest.fixture(scope="module")
def model():
    return h.default_model()


@pytest.mark.parametrize("name", PAGES)
def test_page(model, name):
    page, want = PAGES[name]
    got = h.main_text(f"<!doctype html><html><head><title>x</title></head>{page}</body></html>", model).split("\n")
    lost = [x for x in want if x not in got]
    assert not lost, (name, lost)
    assert got == want, (name, [x for x in got if x not in want])


def test_recall_and_precision_over_all_shapes(model):
    kept = lost = extra = 0
    for page, want in PAGES.values():
        got = h.main_text(page, model).split("\n")
        kept += sum(len(x) for x in want if x in got)
        lost += sum(len(x) for x in want if x not in got)
        extra += sum(len(x) for x in got if x not in want)
    assert kept / (kept + lost) >= 0.98 and kept / (kept + extra) >= 0.98


def test_many_named_elements_stay_linear(model):
    """Names are handed down once: as deep as wide, and no name of a page-wide wrapper counts."""
    page = '<div class="sidebar">' * 20_000 + f"<h1>{T}</h1>{ps()}"
    assert h.main_text(page, model).split("\n")[-3:] == P
