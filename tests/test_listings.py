from tidelog.sources.listings import list_catalog_files, list_resource_links

PAGE = """
<html><body>
<ul class="nav"><li><a class="heading" title="x">x</a><a class="resource-url-analytics" href="/outside.zip">x</a></li></ul>
<ul class="big resource-list">
  <li class="item"><a class="heading" href="#" title="first">First</a>
     <ul><li>more</li><li><a target="_blank" class="btn resource-url-analytics" href="https://example.org/x/A_TO.zip">get</a></li></ul></li>
  <li><a class='heading' title='second'>Second</a><a class='resource-url-analytics' href='https://example.org/x/B.pdf'>get</a></li>
  <li><a title="third" class="wide heading">Third</a></li>
  <li><a class="heading">No title</a><a href="/C.zip" class="resource-url-analytics">get</a><a href="/D.zip" class="resource-url-analytics">again</a></li>
  <li><a class="subheading" title="no">No</a><a class="resource-url-analytics" href="/E.zip">get</a></li>
</ul>
<ul><li><a class="heading" title="y">y</a><a class="resource-url-analytics" href="/after.zip">y</a></li></ul>
</body></html>
"""


def pages(spark, *texts):
    return spark.createDataFrame([(n, f"u{n}", text) for n, text in enumerate(texts)], "page_id long, url string, html string")


def test_catalogue(spark):
    found = list_catalog_files(pages(spark, PAGE, "<p>nothing</p>", None)).collect()
    assert [(r["page_id"], r["file_name"]) for r in found] == [(0, "A_TO.zip"), (0, "C.zip")]
    assert found[0]["link"] == "https://example.org/x/A_TO.zip"
    assert [r["file_name"] for r in list_catalog_files(pages(spark, PAGE), "pdf").collect()] == ["B.pdf"]


def test_unclosed_catalogue_runs_to_the_end(spark):
    page = '<UL CLASS="resource-list"><li><a class="heading" title="t">t</a><a class="resource-url-analytics" href="q/z.zip">t</a>'
    assert [r["file_name"] for r in list_catalog_files(pages(spark, page)).collect()] == ["z.zip"]


def test_plain_links(spark):
    page = '<ul><li><a href="/d/one.zip">1</a></li><li><a href="/two.txt">2</a></li></ul><a href="/three.zip">3</a>'
    found = list_resource_links(pages(spark, page), ".zip")
    assert found.columns == ["page_id", "url", "link", "file_name"]
    assert [r["file_name"] for r in found.collect()] == ["one.zip"]
