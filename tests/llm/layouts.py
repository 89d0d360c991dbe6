"""Page layouts that the extraction was not trained on, each with the blocks
of its main text: (name, html, blocks)."""

A = "The old bridge over the river was closed on Monday after engineers found cracks in two of its pillars."
B = "Officials said that repairs will take at least six weeks, and that traffic will be sent through the town."
C = "Shop owners fear for their sales; many had hoped for a good summer after two difficult years."
D = "A new bridge has been planned since 1998, but the money for it was never granted by the state."
E = "Closed until further notice"
T = "Bridge closed"
LINKS = '<a href="/">Home</a> <a href="/n">News</a> <a href="/s">Sport</a> <a href="/w">Weather</a>'
LI = '<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li></ul>'
READ = f'<ul><li><a href="/1">{A[:40]}</a></li><li><a href="/2">{C[:45]}</a></li><li><a href="/3">{D[:38]}</a></li></ul>'
REMARKS = "".join(f"<div><b>{n}</b><p>{t}</p><a href='#r'>Reply</a></div>" for n, t in (("Ann", "I agree!"), ("Bob", "They knew this for years."), ("Cy", "What about the ferry?")))
ABC = f"<p>{A}</p><p>{B}</p><p>{C}</p>"
PS = [A, B, C]


def page(body, head=""):
    return f"<!doctype html><html><head><title>{T} - The Paper</title>{head}</head><body>{body}</body></html>"


LAYOUTS = [
    ("bare body", page(f"<h1>{T}</h1><p>{A}</p><p>{B}</p>"), [T, A, B]),
    ("bare body, same line twice", page(f"<h1>Bridge</h1><p>{A}</p><p>{A}</p>"), ["Bridge", A, A]),
    ("bare body with footer", page(f"<h1>{T}</h1>{ABC}<footer>Imprint</footer>"), [T, *PS]),
    ("topbar and post-content", page(f'<div class="topbar">{LINKS}</div><div class="post-content"><h1>{T}</h1>{ABC}</div>'), [T, *PS]),
    ("disqus", page(f'<article><h1>{T}</h1>{ABC}</article><section id="disqus_thread">{REMARKS}</section>'), [T, *PS]),
    ("alert inside", page(f'<article><h1>{T}</h1><p>{A}</p><div class="alert">Please subscribe now.</div><p>{B}</p></article>'), [T, A, B]),
    ("role complementary", page(f'<main><h1>{T}</h1>{ABC}<div role="complementary"><h3>More</h3><p>{D}</p></div></main>'), [T, *PS]),
    ("wrapper divs", page(f'<div id="wrap"><div id="top">{LI}</div><div id="mid"><h1>{T}</h1>{ABC}</div><div id="bot">© 2024 The Paper</div></div>'), [T, *PS]),
    ("table layout", page(f"<table><tr><td>{LI}</td><td><h1>{T}</h1>{ABC}</td></tr></table>"), [T, *PS]),
    ("roles only", page(f'<div role="banner">The Paper</div><div role="navigation">{LI}</div><div role="main"><h1>{T}</h1>{ABC}</div><div role="contentinfo">© 2024</div>'), [T, *PS]),
    ("blog with sharebox", page(f'<div class="blog"><div class="blog-post"><h2>{T}</h2>{ABC}<div class="sharebox">{LINKS}</div></div></div>'), [T, *PS]),
    ("nav links by unknown name", page(f'<div class="xq">{LINKS}</div><div class="zk"><h1>{T}</h1>{ABC}</div>'), [T, *PS]),
    ("footer links by unknown name", page(f'<div class="zk"><h1>{T}</h1>{ABC}</div><div class="xq">{LINKS}</div>'), [T, *PS]),
    ("remarks by unknown name", page(f'<div class="zk"><h1>{T}</h1>{ABC}<p>{D}</p></div><div class="xq"><h3>3 voices</h3>{REMARKS}</div>'), [T, *PS, D]),
    ("comment list", page(f'<article><h1>{T}</h1>{ABC}</article><ol class="commentlist"><li><p>{D}</p></li><li><p>I agree!</p></li></ol>'), [T, *PS]),
    ("comments inside the article", page(f'<article><h1>{T}</h1>{ABC}<div id="comments"><p>{D}</p><p>Me too.</p></div></article>'), [T, *PS]),
    ("camel case", page(f'<div class="siteHeader">The Paper</div><div class="articleBody"><h1>{T}</h1>{ABC}</div><div class="siteFooter"><p>{D}</p></div>'), [T, *PS]),
    ("cookie banner first", page(f'<div id="cookie-law"><p>We use cookies to make this site better for you, and you may refuse them.</p></div><main><h1>{T}</h1>{ABC}</main>'), [T, *PS]),
    ("gdpr popup last", page(f'<main><h1>{T}</h1>{ABC}</main><div class="gdprPopup"><p>We value your privacy and ask you to agree to our terms.</p></div>'), [T, *PS]),
    ("related list inside", page(f'<article><h1>{T}</h1><p>{A}</p><div class="related-posts">{READ}</div><p>{B}</p></article>'), [T, A, B]),
    ("read next by unknown name", page(f'<div class="zk"><h1>{T}</h1>{ABC}</div><div class="qq"><h4>Read next</h4>{READ}</div>'), [T, *PS]),
    ("two column", page(f'<div class="row"><div class="col-8"><h1>{T}</h1>{ABC}</div><div class="col-4"><h4>Popular</h4>{READ}</div></div>'), [T, *PS]),
    ("sidebar first", page(f'<div id="sidebar-left"><h3>About us</h3><p>{D}</p></div><div id="center"><h1>{T}</h1>{ABC}</div>'), [T, *PS]),
    ("quote and list", page(f"<main><h1>{T}</h1><p>{A}</p><blockquote>{D}</blockquote><ul><li>{B}</li><li>{C}</li></ul></main>"), [T, A, D, B, C]),
    ("headed sections", page(f"<div class='doc'><h1>{T}</h1><section><h2>What</h2><p>{A}</p></section><section><h2>When</h2><p>{B}</p></section></div>"), [T, "What", A, "When", B]),
    ("table of facts inside", page(f"<article><h1>{T}</h1><p>{A}</p><table><tr><td>Length</td><td>{E}</td></tr></table><p>{B}</p></article>"), [T, A, "Length", E, B]),
    ("figure", page(f"<article><h1>{T}</h1><figure><img src='x'><figcaption>{E}</figcaption></figure>{ABC}</article>"), [T, E, *PS]),
    ("newsletter form inside", page(f'<article><h1>{T}</h1><p>{A}</p><form class="signup-box"><p>Get our letter every week.</p><input></form><p>{B}</p></article>'), [T, A, B]),
    ("ads between", page(f'<div class="story-text"><h1>{T}</h1><p>{A}</p><div class="ad-slot"><p>Buy this car today and save a lot of money.</p></div><p>{B}</p></div>'), [T, A, B]),
    ("sponsored after", page(f'<section class="prose"><h1>{T}</h1>{ABC}</section><section class="sponsored-content"><h3>Buy it</h3><p>{D}</p></section>'), [T, *PS]),
    ("old fonts", page(f"<center><font size=5>The Paper</font></center><hr>{LINKS}<hr><h2>{T}</h2><p>{A}<p>{B}<p>{C}<hr><address>webmaster</address>"), [T, *PS]),
    ("deep nesting", page(f"<div><div><div><div><h1>{T}</h1><div><p>{A}</p></div><div><p>{B}</p></div></div></div></div></div>"), [T, A, B]),
    ("breadcrumb and byline", page(f'<main><div class="crumbs">{LINKS}</div><h1>{T}</h1>{ABC}</main>'), [T, *PS]),
    ("notice bar", page(f'<div class="noticebar"><p>This site will be offline on Sunday for some hours.</p></div><div class="page"><h1>{T}</h1>{ABC}</div>'), [T, *PS]),
    ("links in text", page(f'<div id="text"><h1>{T}</h1><p>The <a href="/b">bridge</a> was closed on Monday, <a href="/x">officials</a> said.</p><p>{B}</p></div>'), [T, "The bridge was closed on Monday, officials said.", B]),
    ("tag cloud", page(f'<article><h1>{T}</h1>{ABC}</article><div class="tag-cloud"><a href="/1">river</a> <a href="/2">traffic</a></div>'), [T, *PS]),
]
