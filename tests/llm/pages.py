"""Hand-made pages of several templates, each with the text that is its article."""

from __future__ import annotations

A = "The council met on Tuesday evening to discuss the new budget, which had been postponed twice since the spring."
B = "Several members argued that the plan, though cautious, would leave too little money for schools and for roads. Others disagreed."
C = "After three hours of debate the proposal was accepted by a narrow majority, and the mayor thanked all of those who had taken part."
D = "A second vote is expected in June. Until then, the old rules stay in force."
E_ = "Die Gemeinde hat am Dienstag über den neuen Haushalt beraten, der seit dem Frühling zweimal verschoben worden war."


def p(*texts: str) -> str:
    return "".join(f"<p>{t}</p>" for t in texts)


PAGES = {
    "wrapper": (f'<html><body><div class="page-wrap"><div class="top"><a href="/">Home</a> <a href="/n">News</a></div>{p(A, B, C)}<div>Copyright 2020 Site</div></div></body></html>', f"{A} {B} {C}"),
    "bare": (f"<html><body>{p(A, B, C, D)}</body></html>", f"{A} {B} {C} {D}"),
    "fragment": (p(A, B, C), f"{A} {B} {C}"),
    "table": (f'<html><body><table><tr><td><a href=1>Home</a></td><td><a href=2>Sport</a></td><td><a href=3>Contact</a></td></tr><tr><td>{p(A, B, C)}</td></tr></table></body></html>', f"{A} {B} {C}"),
    "quote": (f'<html><body><article><h1 title="x>Budget</h1>{p(A, B, C)}</article></body></html>', f"Budget {A} {B} {C}"),
    "comments": (
        f'<html><body><article><h1>Budget accepted</h1>{p(A, B, C)}</article><section class="comments"><h3>Comments</h3><div class="comment"><p>I do not agree with this at all, it was a bad evening.</p></div>'
        f'<div class="comment"><p>Great article, thanks!</p></div></section></body></html>', f"Budget accepted {A} {B} {C}"),
    "nested": (f'<html><body><main><article><h1>Budget accepted</h1>{p(A, B, C)}<section class="comments"><article class="comment"><p>I like it.</p></article></section></article></main><footer>© 2021 Example</footer></body></html>', f"Budget accepted {A} {B} {C}"),
    "random names": (f'<html><body><div class="qx"><ul class="zz1"><li><a href=1>Home</a></li><li><a href=2>News</a></li><li><a href=3>Contact</a></li></ul></div><div class="kfe"><h1>Budget accepted</h1>{p(A, B, C, D)}</div><div class="pw"><p>© 2022 Example Ltd. All rights reserved.</p></div></body></html>', f"Budget accepted {A} {B} {C} {D}"),
    "post": (f'<html><body><div id="header"><h1>Daily news</h1></div><div id="sidebar"><h3>Related</h3><ul><li><a href=1>Another story</a></li></ul></div><div class="entry-content"><h2>Haushalt</h2>{p(E_, B)}<ul><li>one point of the plan</li><li>another point of the plan</li></ul>{p(C)}</div><div id="footer">Imprint</div></body></html>',
        f"Haushalt {E_} {B} one point of the plan another point of the plan {C}"),
    "notice and advert": (f'<html><head><title>T</title><style>p{{}}</style></head><body><div id="cookie-notice">We use cookies.</div><nav><a href=1>Home</a></nav><article><h1>Budget</h1>{p(A)}<div class="advert">Buy this.</div>{p(B, C)}</article><form><p>Sign up</p></form></body></html>', f"Budget {A} {B} {C}"),
    "entities": (f"<html><body><article><p>Caf&eacute;  &amp;\n cr&#232;me, 3 &lt; 5</p>{p(A, B)}</article></body></html>", f"Café & crème, 3 < 5 {A} {B}"),
    "loose less-than": (f"<html><body><article>{p(A, 'if a < b and b > c then stop', B)}</article></body></html>", f"{A} if a < b and b > c then stop {B}"),
    "blog": (f'<body class="single"><header id="masthead" class="site-header"><p class="site-title"><a href="/">The Blog</a></p><nav class="main-navigation"><ul><li><a href="#">Home</a></li><li><a href="#">About</a></li></ul></nav></header><div id="content" class="site-content"><article class="post-12"><h1 class="entry-title">A vote in June</h1><div class="entry-content">{p(A,B,C)}<h3>What is next</h3>{p(D)}</div></article><div id="comments"><h2>2 thoughts</h2><ol class="comment-list"><li><p>Thank you for this report, I had missed the meeting.</p></li><li><p>Not a good decision, if you ask me.</p></li></ol><form><p>Leave a reply</p><p>Your email</p></form></div></div><aside class="widget-area"><h2>Recent Posts</h2><ul><li><a href="#">Old market closes</a></li></ul></aside><footer class="site-footer">Proudly powered</footer></body>', f'A vote in June {A} {B} {C} What is next {D}'),
    "plain divs": (f'<body><div><div><a href=1>Start</a><a href=2>Politik</a><a href=3>Sport</a></div></div><div><div>{E_}</div><div>{B}</div><div>{C}</div></div><div><div>© 2019 Zeitung GmbH</div></div></body>', f'{E_} {B} {C}'),
    "short article": (f'<body><nav><a href=1>Home</a></nav><article><h1>Note</h1><p>It rained.</p></article><footer>© 2020</footer></body>','Note It rained.'),
    "list": (f'<body><ul><li><a href=1>Home</a></li><li><a href=2>Shop</a></li></ul><div class="content"><h1>Steps</h1><ol><li>Take the red box from the shelf.</li><li>Open it.</li><li>Read the note inside, slowly.</li></ol>{p(D)}</div></body>',f'Steps Take the red box from the shelf. Open it. Read the note inside, slowly. {D}'),
    "advert inside": (f'<body><main><h1>Vote</h1>{p(A)}<div class="ad-slot">Sale 50 % off, only today</div>{p(B)}<div class="newsletter"><p>Subscribe to our newsletter</p><input></div>{p(C)}</main></body>',f'Vote {A} {B} {C}'),
    "French": (f'<body><div class="bandeau-cookie cookie">Nous utilisons des cookies.</div><div class="menu"><a href=1>Accueil</a></div><div class="texte article"><h1>Le conseil</h1>{p("Le conseil municipal s est réuni mardi soir pour discuter du nouveau budget, reporté deux fois depuis le printemps.", "Plusieurs élus ont estimé que le plan, bien que prudent, laisserait trop peu d argent aux écoles.")}</div><div class="pied footer">Mentions légales</div></body>','Le conseil Le conseil municipal s est réuni mardi soir pour discuter du nouveau budget, reporté deux fois depuis le printemps. Plusieurs élus ont estimé que le plan, bien que prudent, laisserait trop peu d argent aux écoles.'),
    "old tables": (f'<table width=100%><tr><td colspan=2>My Homepage</td></tr><tr><td width=20%><a href=1>Links</a><br><a href=2>Guestbook</a></td><td><h2>Welcome</h2>{p(A,B)}</td></tr><tr><td colspan=2>Copyright 1999 Webmaster</td></tr></table>',f'Welcome {A} {B}'),
    "related links": (f'<body><section class="story">{p(A,B,C)}</section><section class="related"><h4>Related articles</h4><p><a href=1>Mayor resigns after long dispute over budget</a></p><p><a href=2>Roads to be repaired next year, says council</a></p></section></body>',f'{A} {B} {C}'),
    "quotation": (f'<body><article>{p(A)}<blockquote>We had no choice.</blockquote>{p(C)}<pre>x = 1</pre></article></body>',f'{A} We had no choice. {C} x = 1'),
}
