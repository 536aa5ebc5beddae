"""Pages of other outlines than those of the test table, each with the exact text of its article."""

LONG = "The council met on Monday, and after a long debate it agreed to open the old bridge again, said the mayor."
MORE = "Work begins in spring; until then, boats are to carry people over, as they did before the bridge was built."
END = "Nobody knows yet what it will cost, but the plans can be seen at the town hall, where questions are welcome."
MENU = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/a">About us</a></li></ul></nav>'
FOOT = "<footer><p>Copyright 2020 The Paper</p><p><a>Imprint</a> <a>Privacy</a></p></footer>"


def page(inner, before=MENU, after=FOOT):
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{before}{inner}{after}</body></html>"


def remarks(outer, inner, author="b"):
    said = [("Ann", "I was there and it rained."), ("Bo K.", "Not true at all, the bridge is fine as it is."), ("Cy", "First!"), ("Dee", "Thanks for this.")]
    return f"<{outer}><h3>4 comments</h3>" + "".join(f"<{inner}><{author}>{a}</{author}><span>3 May 10:12</span><p>{t}</p></{inner}>" for a, t in said) + f"</{outer.split()[0]}>"


P = f"<p>{LONG}</p><p>{MORE}</p>"
T = f"{LONG}\n{MORE}"

KINDS = {
    "plain article": (page(f"<article><h1>Old bridge</h1>{P}<p>{END}</p></article>"), f"Old bridge\n{T}\n{END}"),
    "table": (
        page(f"<article><h1>Costs</h1>{P}<table><tr><th>Part</th><th>Cost</th></tr><tr><td>Piers</td><td>100</td></tr><tr><td>Deck</td><td>250</td></tr></table><p>{END}</p></article>"),
        f"Costs\n{T}\nPart\nCost\nPiers\n100\nDeck\n250\n{END}",
    ),
    "table with body and caption": (
        page(f"<main>{P}<table><caption>Costs by year</caption><tbody><tr><td>2019</td><td>12.5</td></tr><tr><td>2020</td><td>13.1</td></tr></tbody></table></main>"),
        f"{T}\nCosts by year\n2019\n12.5\n2020\n13.1",
    ),
    "lists of single words": (
        page(f"<article>{P}<ul><li>Oak</li><li>Stone</li><li>Steel</li></ul><ol><li>Measure</li><li>Cut</li></ol><p>{END}</p></article>"),
        f"{T}\nOak\nStone\nSteel\nMeasure\nCut\n{END}",
    ),
    "definitions": (
        page(f"<article>{P}<dl><dt>Pier</dt><dd>What carries the deck, of stone.</dd><dt>Deck</dt><dd>What people walk on.</dd></dl></article>"),
        f"{T}\nPier\nWhat carries the deck, of stone.\nDeck\nWhat people walk on.",
    ),
    "code and definitions in a plain box": (
        page(f'<div class="content"><h1>How to</h1>{P}<pre>make bridge\nmake open</pre><dl><dt>make</dt><dd>Builds things, if told what.</dd></dl><p>{END}</p></div>'),
        f"How to\n{T}\nmake bridge make open\nmake\nBuilds things, if told what.\n{END}",
    ),
    "figure and quotation": (
        page(f"<article>{P}<figure><img src=a><figcaption>The bridge in 1910</figcaption></figure><blockquote><p>{END}</p></blockquote></article>"),
        f"{T}\nThe bridge in 1910\n{END}",
    ),
    "links in sentences": (
        page(f"<article>{P}<p>See the <a>county report</a> for <a>details</a>.</p><p><a>Maps</a> and <a>plans</a> are there too.</p><p>{END}</p></article>"),
        f"{T}\nSee the county report for details.\nMaps and plans are there too.\n{END}",
    ),
    "named inline elements": (
        page(f'<article><p>The <span class="term">pier</span> is <em class="x">very</em> old, and <a class="share">this one</a> too.</p>{P}</article>'),
        f"The pier is very old, and this one too.\n{T}",
    ),
    "comments under discussion": (page(f'<article>{P}<p>{END}</p></article>{remarks("section id=discussion", "div")}'), f"{T}\n{END}"),
    "comments under a plain list": (page(f'<article>{P}<p>{END}</p></article>{remarks("div class=c-list", "div", "span")}'), f"{T}\n{END}"),
    "comments inside the article": (page(f'<article>{P}<p>{END}</p>{remarks("div class=box", "div")}</article>'), f"{T}\n{END}"),
    "sections with headings": (
        page(f"<main><h1>Bridge</h1><section><h2>Past</h2>{P}</section><section><h2>Future</h2><p>{END}</p></section></main>"),
        f"Bridge\nPast\n{T}\nFuture\n{END}",
    ),
    "notices and adverts between paragraphs": (
        page(f'<article><p>{LONG}</p><div class="advert"><p>Buy boats now, cheap!</p></div><p>{MORE}</p><div class="newsletter"><form><label>Mail</label></form></div></article>', '<div class="cookie-notice"><p>We use cookies.</p></div>' + MENU),
        T,
    ),
    "deep boxes": (page("<div>" * 40 + f"<article>{P}</article>" + "</div>" * 40), T),
}
