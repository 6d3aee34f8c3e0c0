"""A few pages labelled by hand: what stands between the two marks is the article.

They cover the usual furniture of pages under its usual names. More pages can be given to
``html_text.learn``.
"""

from __future__ import annotations

OPEN, CLOSE = "<!--article-->", "<!--/article-->"

_PROSE = (
    "The river rose in the night and by morning the lower road was closed to all but the carts.",
    "Nobody in the village had seen water so high, and the old men argued about the year it last happened.",
    "Two boats were brought from the mill, and with them the baker and his brother fetched the families near the bridge.",
    "When the rain stopped the fields lay under a thin brown lake that took a week to drain away.",
    "The council met on Friday to decide who would pay for the bank, which had given way in three places.",
    "It was agreed to rebuild it with stone, though the stone would have to come from the quarry beyond the hill.",
)


def _prose(*which: int) -> str:
    return "".join(f"<p>{_PROSE[i % len(_PROSE)]}</p>" for i in which)


def _links(words: str, around: str = "li") -> str:
    return "".join(f'<{around}><a href="/{w}">{w}</a></{around}>' for w in words.split())


def _page(before: str, article: str, after: str) -> str:
    return f"<!DOCTYPE html><html><head><title>Flood</title></head><body>{before}{OPEN}{article}{CLOSE}{after}</body></html>"


PAGES = (
    _page(
        f"<header><h2>Valley Post</h2></header><nav><ul>{_links('Home News Sport Weather')}</ul></nav><article>",
        f"<h1>High water</h1>{_prose(0, 1, 2)}<p><b>Later</b> the <a href='/m'>mill</a> opened again.<br>It had lost its wheel.</p>",
        "</article><footer><p>All rights reserved. Valley Post.</p></footer>",
    ),
    _page(
        f"<div class='top-bar'><ul class='menu'>{_links('Start Archive Authors')}</ul></div><div class='banner'><p>Spring sale now on.</p></div><main class='content'>",
        f"<h1>The bank</h1><section><h2>What broke</h2>{_prose(3, 4)}</section><ul><li>stone from the quarry</li><li>carts from the farms</li><li>men from every house in the valley</li></ul>{_prose(5)}",
        f"</main><aside class='sidebar'><h3>Related</h3><ul>{_links('Rain Mills Roads Bridges')}</ul></aside><div id='footer'>Imprint and contact</div>",
    ),
    _page(
        "<div class='cookie notice'><p>We use cookies to improve this site. Read our policy.</p><button>Accept</button></div><div class='wrapper'><div class='post'>",
        f"<h1>Boats</h1><div class='entry text'>{_prose(2, 0)}<blockquote><p>We rowed until noon.</p></blockquote>{_prose(1)}</div>",
        "</div><div class='share social'><a href='#'>Mail</a> <a href='#'>Print</a></div><div id='comments' class='comments'><h3>Comments</h3><div class='comment'><p>Great story, my uncle was there!</p></div><div class='comment reply'><p>Mine too, thank you.</p></div></div></div>",
    ),
    _page(
        f"<div role='banner'><h2>News</h2></div><div role='navigation'>{_links('World Local Arts', 'span')}</div><div class='ad'>Buy three boots and pay for two.</div><div class='story-body'>",
        f"<h1>Rain ends</h1>{_prose(3)}<figure><img src='a.png'><figcaption>The bridge on Sunday.</figcaption></figure>{_prose(4, 5)}<table><tr><th>Day</th><td>Height in feet</td></tr></table>",
        "</div><div class='advert sponsored'><p>Roofs mended while you wait.</p></div><form action='/s'><label>Your mail</label><input name='m'><button>Subscribe</button></form><div class='newsletter signup'><p>Get our letter every week.</p></div>",
    ),
    _page(
        f"<header class='header'><a href='/'>Gazette</a></header><nav class='navbar breadcrumb'>{_links('Home Region Floods', 'span')}</nav><div class='popup modal'><p>Please log in to read on.</p></div><article class='article post'><header>",
        f"<h1>A new bank of stone</h1><p>By the clerk of the council</p></header>{_prose(4)}<h2>The cost</h2>{_prose(5)}<pre>stone 40, carts 12</pre><ol><li>First the ditch is dug down to the clay.</li><li>Then the stone is laid in rows.</li></ol><p>So it goes on.</p>",
        f"<div class='related recommended'><h3>More</h3><ul>{_links('Quarry Hill Council')}</ul></div></article><section id='respond' class='comments'><form><textarea>Write here</textarea></form></section><footer class='site-footer'><ul>{_links('About Privacy Terms')}</ul></footer>",
    ),
    _page(
        "<noscript><p>Please turn on scripts.</p></noscript><div class='alert message'>Service may be slow today.</div><div id='main' class='site page container'><div class='col top message'>",
        f"<h1>Mill wheel found</h1><div class='lead'><p>It lay in the reeds a mile below.</p></div><div class='body'>{_prose(0)}<p>The <em>baker</em> found it, <strong>to his own surprise</strong>, with a <span>long pole</span>.</p>{_prose(2)}</div>",
        f"</div></div><div class='widget promo'><p>Win a boat trip.</p></div><div class='pagination'>{_links('Older Newer', 'span')}</div><div class='tags'>{_links('water mills', 'span')}</div><div role='contentinfo' class='copyright legal'>Copyright the Gazette</div><dialog class='login'><p>Log in</p></dialog>",
    ),
    _page(
        f"<div class='skip'><a href='#c'>Skip to content</a></div><aside role='complementary'><p>Most read this week</p>{_links('One Two Three')}</aside><section class='section header-less'><article class='author-post'>",
        f"<h1>Council meets</h1>{_prose(4, 1)}<dl><dt>Present</dt><dd>all but two of the members</dd></dl><div><p>A vote was taken.</p></div>{_prose(3)}",
        "</article></section><div class='disqus discussion feedback'><p>Reader one says hello to all.</p></div><div class='ads advertisement'><p>Cheap carts, good wheels.</p></div><div class='consent gdpr'><p>Choose what we may store.</p></div><select><option>English</option></select>",
    ),
    _page(
        f"<div id='sidebar' class='nav'>{_links('Up Down', 'div')}</div><div class='search'><form><input><button>Find</button></form></div><div class='subscribe'><p>Join us for one coin a week.</p></div><div id='content'><div class='title'>",
        f"<h1>After the flood</h1></div>{_prose(5, 3, 1)}<hr><h3>Notes</h3><p>Heights were read at the <code>east</code> post, <i>twice</i> a <u>day</u>.</p>",
        f"</div><div class='toolbar'>{_links('Save Copy', 'span')}</div><div class='sponsor'><p>Paid for by the mill.</p></div><div class='author bio'><p>She writes about water.</p></div><menu>{_links('Top End')}</menu>",
    ),
)
