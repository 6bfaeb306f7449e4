"""Pages written by hand in layouts of their own, each with the blocks of its article."""

P1 = "The council met on Tuesday to discuss the new bridge over the river."
P2 = "After three hours of debate, the members voted nine to four in favour of the plan."
P3 = "Work is expected to begin next spring, and the road will be closed for several weeks."
P4 = "Residents of the old town had asked for a smaller project, which would have cost far less."

PAGES = [
    # unnamed elements only
    (f"<body><div><div><h1>A new bridge</h1><p>{P1}</p><p>{P2}</p></div></div></body>", ["A new bridge", P1, P2]),
    (f"<body><div><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></div><div><h1>A new bridge</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></div>"
     "<div>&copy; 2021 The Daily</div></body>", ["A new bridge", P1, P2, P3]),
    # wrappers whose names speak of furniture
    (f'<body><div class="sidebar-layout"><main><h1>A new bridge</h1><p>{P1}</p><p>{P2}</p></main><aside class="sidebar"><h3>About us</h3>'
     "<p>We report from the valley.</p></aside></div></body>", ["A new bridge", P1, P2]),
    (f'<body class="post-comments-enabled has-sidebar"><div class="wrap"><article class="post"><h2>A new bridge</h2><p>{P1}</p><p>{P4}</p></article>'
     '<section id="comments"><h3>2 comments</h3><ol><li>Good news!</li><li>Too expensive, I think.</li></ol></section></div></body>',
     ["A new bridge", P1, P4]),
    (f'<body><div class="post-comments-enabled"><div class="entry-content"><p>{P1}</p><p>{P2}</p><p>{P3}</p></div></div></body>', [P1, P2, P3]),
    # parts of an article that are no paragraphs
    (f"<body><nav><a href=/>Home</a></nav><article><h1>A glossary of bridges</h1><p>{P1}</p><dl><dt>Arch</dt><dd>A curved span that carries its load to both ends.</dd>"
     "<dt>Truss</dt><dd>A frame of many triangles.</dd></dl></article></body>",
     ["A glossary of bridges", P1, "Arch", "A curved span that carries its load to both ends.", "Truss", "A frame of many triangles."]),
    (f'<body><article><p>{P1}</p><figure><img src="b.jpg"><figcaption>The bridge as the architects see it.</figcaption></figure><p>{P2}</p></article>'
     "<footer><p>&copy; 2021 The Daily. All rights reserved.</p></footer></body>", [P1, "The bridge as the architects see it.", P2]),
    (f'<body><article><p>{P1}</p><form class="newsletter"><label>Your email</label><input><button>Subscribe</button></form><p>{P2}</p><p>{P3}</p></article></body>', [P1, P2, P3]),
    (f'<body><header class="site-header"><div class="logo">The Daily</div></header><article><h1>Sources</h1><p>{P1}</p><ul><li><a href="/1">The report of the council on all crossings</a></li>'
     '<li><a href="/2">A letter from the residents of the old town</a></li></ul></article></body>',
     ["Sources", P1, "The report of the council on all crossings", "A letter from the residents of the old town"]),
    (f"<body><main><p>{P1}</p><p>The span is <math><mi>x</mi><mo>=</mo><mn>4</mn></math> metres.</p><p>{P2}</p></main></body>", [P1, "The span is x=4 metres.", P2]),
    (f'<body><article><p>{P1}</p><object data="map.svg">A map of the river and its bridges.</object><p>{P3}</p></article></body>',
     [P1, "A map of the river and its bridges.", P3]),
    (f"<body><article><h1>Costs</h1><p>{P1}</p><table><tr><th>Part</th><th>Cost</th></tr><tr><td>Piers</td><td>4 million</td></tr></table><p>{P2}</p></article></body>",
     ["Costs", P1, "Part", "Cost", "Piers", "4 million", P2]),
    (f"<body><article><blockquote><p>{P4}</p></blockquote><p>{P1}</p><pre>one\ntwo</pre><p>{P2}</p></article></body>", [P4, P1, "one two", P2]),
    # furniture around it
    (f'<body><div class="cookie-notice">This site uses cookies. <button>Accept</button></div><div id="content"><h1>A new bridge</h1><p>{P1}</p><p>{P2}</p></div>'
     '<div class="related"><h4>Related</h4><ul><li><a href=/1>Ferry sold</a></li><li><a href=/2>Road closed</a></li></ul></div></body>', ["A new bridge", P1, P2]),
    (f'<body><nav class="breadcrumb"><a href=/>Home</a> / <a href=/t>Town</a></nav><section class="story"><h2>A new bridge</h2><p>{P1}</p><div class="ad">Buy now and save!</div>'
     f"<p>{P2}</p><p>{P3}</p></section><footer><a href=/p>Privacy</a> <a href=/t>Terms</a></footer></body>", ["A new bridge", P1, P2, P3]),
    (f'<body><div id="page"><div id="header"><h1><a href=/>The Daily</a></h1></div><div id="main"><div class="post"><h2>A new bridge</h2><p>{P1}</p><p>{P4}</p></div></div>'
     '<div id="sidebar"><h3>Categories</h3><ul><li><a href=/a>Town</a></li><li><a href=/b>Sport</a></li></ul></div><div id="footer">Powered by paper</div></div></body>',
     ["A new bridge", P1, P4]),
    (f'<body><main class="article-body"><section><h2>What was decided</h2><p>{P2}</p></section><section><h2>What comes next</h2><p>{P3}</p></section></main>'
     '<div class="share"><a href=/f>Share</a><a href=/t>Tweet</a></div></body>', ["What was decided", P2, "What comes next", P3]),
    (f'<body><article><h1>A new bridge</h1><p>{P1}</p><aside class="promo">Sign up for our letter today.</aside><p>{P2}</p></article><div class="comments-area"><h2>Leave a reply</h2>'
     "<form><label>Name</label><input><label>Comment</label><textarea>text</textarea></form></div></body>", ["A new bridge", P1, P2]),
    (f'<body><div class="container"><div class="row"><div class="col-8"><h1>A new bridge</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></div><div class="col-4 widget-area"><h3>Popular</h3>'
     "<ul><li><a href=/1>Ferry sold</a></li></ul></div></div></div></body>", ["A new bridge", P1, P2, P3]),
    (f"<body><p>{P1}</p><p>{P2}</p><p>{P3}</p><p>{P4}</p></body>", [P1, P2, P3, P4]),
    (f"<article>{P1}<p>{P2}<p>{P3}<ul><li>First the piers<li>Then the deck of the bridge</ul></article>", [P1, P2, P3, "First the piers", "Then the deck of the bridge"]),
    (f'<body><div role="navigation"><a href=/>Home</a><a href=/m>More</a></div><div role="main"><h1>A new bridge</h1><p>{P1}</p><p>{P2}</p></div><div role="contentinfo">&copy; 2020</div></body>',
     ["A new bridge", P1, P2]),
    ('<body><nav><ul><li><a href=/>Home</a></li><li><a href=/c>Contact</a></li></ul></nav><footer>&copy; 2021 The Daily</footer></body>', []),
    (f'<body><div class="main-content"><div class="article-header"><h1>A new bridge</h1></div><div class="article-text"><p>{P1}</p><p>{P2}</p></div></div>'
     '<div class="site-footer"><p>Contact: news@daily.example</p></div></body>', ["A new bridge", P1, P2]),
]
