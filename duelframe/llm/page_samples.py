"""The small labelled table behind the block classifier: hand-made pages.

Each page is HTML in which the text of every block starts with ``+`` (main
text) or ``-`` (not), then a number of words in ``{}``; ``{l:n}`` are n linked
words.  The words themselves do not matter, only their number and links do.
"""

PAGES = (
    # a news page with an article element
    "<header><h1>-{3}</h1><p>-{6}</p></header><nav><ul><li>-{l:1}</li><li>-{l:2}</li><li>-{l:1}</li></ul></nav>"
    "<article><h1>+{8}</h1><p>+{40}</p><p>+{3}</p><p>+{85}</p><h2>+{4}</h2><p>+{22}</p><ul><li>+{7}</li><li>+{9}</li></ul>"
    "<blockquote>+{18}</blockquote><p>+{1}</p><aside><p>-{14}</p><p>-{l:6}</p></aside><p>+{55}</p></article>"
    "<aside><h3>-{2}</h3><p>-{30}</p><p>-{l:9}</p></aside><footer><p>-{12}</p><p>-{l:4}</p></footer>",
    # a blog with comments under the post
    "<div class='topbar menu'><a>-{l:1}</a><p>-{l:3}</p></div><div class='cookie-notice'><p>-{25}</p><p>-{l:2}</p></div>"
    "<main><h1>+{6}</h1><p>+{65}</p><p>+{2}</p><p>+{31}{l:3}</p><p>+{12}</p><div class='share'><p>-{l:4}</p></div>"
    "<section class='comments'><h2>-{1}</h2><p>-{45}</p><p>-{16}</p><p>-{80}</p></section></main>"
    "<form><p>-{5}</p><label>-{2}</label></form><footer><p>-{9}</p></footer>",
    # no semantic elements: density alone
    "<div><p>-{l:1}</p><p>-{l:2}</p><p>-{l:1}</p><p>-{l:2}</p></div><div><h1>+{7}</h1><p>+{48}</p><p>+{60}{l:2}</p><p>+{9}</p>"
    "<p>+{33}</p><p>+{75}</p></div><div><p>-{l:5}</p><p>-{l:4}</p><p>-{l:6}</p></div><div><p>-{4}{l:3}</p></div>",
    "<table><tr><td>-{l:2}</td></tr></table><div><h2>+{5}</h2><p>+{24}</p><p>+{17}</p><p>+{90}</p><p>+{6}</p><p>+{44}</p></div>"
    "<div><p>-{2}{l:5}</p><p>-{l:2}</p></div><div><p>-{3}</p></div>",
    "<div><p>-{2}</p><p>-{l:3}</p></div><div><p>+{19}</p><p>+{28}</p><p>+{14}{l:1}</p><p>+{52}</p></div><div><p>-{l:2}</p><p>-{5}</p></div>",
    # adverts and notices in and around the article
    "<div class='ad'><p>-{10}</p></div><article><h1>+{9}</h1><p>+{12}</p><div class='advert'><p>-{21}</p></div><p>+{2}</p><p>+{70}</p>"
    "<div class='notice'><p>-{35}</p></div><p>+{5}{l:4}</p><p>+{1}</p></article><div class='ad'><p>-{26}</p></div>"
    "<footer><p>-{40}</p></footer>",
    # a very short article
    "<nav><p>-{l:4}</p></nav><div class='ad'><p>-{11}</p></div><article><h1>+{2}</h1><p>+{2}</p></article><footer><p>-{15}</p></footer>",
    "<nav><p>-{l:4}</p><p>-{8}</p></nav><article><p>+{1}</p></article><div class='related'><p>-{l:9}</p><p>-{18}</p></div>",
    # a linked article and a text-heavy page around it
    "<div class='sidebar'><p>-{60}</p><p>-{28}</p></div><article><p>+{l:7}</p><p>+{10}{l:20}</p><p>+{36}</p></article>"
    "<div class='sidebar'><p>-{l:12}</p><p>-{75}</p></div><div><p>-{l:2}</p><p>-{22}</p></div>",
    # what stands outside the article of a page that has one
    "<div><p>-{13}</p></div><article><p>+{20}</p><p>+{4}</p></article><div><p>-{38}</p><p>-{5}</p><p>-{l:3}</p></div>",
    "<div><h1>-{4}</h1><p>-{9}</p></div><main><h1>+{5}</h1><p>+{11}</p><p>+{48}</p></main><div><p>-{52}</p></div>",
)
