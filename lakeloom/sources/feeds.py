"""Podcast feeds: the channel and the episodes of RSS documents."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value of the format: the namespace of durations and images.
_ITUNES = "{http://www.itunes.com/dtds/podcast-1.0.dtd}"
_CHANNEL = "readable_id string, rss_url string, title string, description string, language string, last_build_date string, image_url string"
_EPISODE = "readable_id string, channel_readable_id string, channel_rss_url string, title string, description string, url string, audio_url string, episode_link string, duration string, pub_date string, image_url string"


def _readable(url: str) -> str:
    """What follows the scheme."""
    return url.split("//")[-1]


def _text(node: ET.Element, *path: str) -> str | None:
    for tag in path:
        node = node.find(tag)
        if node is None:
            return None
    return node.text


def _image(node: ET.Element) -> str | None:
    found = node.find(f"{_ITUNES}image")
    return None if found is None else found.get("href")


def _channel(url: str, channel: ET.Element) -> Iterator[tuple]:
    image = _image(channel) if channel.find(f"{_ITUNES}image") is not None else _text(channel, "image", "url")
    fields = [_text(channel, tag) for tag in ("title", "description", "language", "lastBuildDate")]
    yield _readable(url).rstrip("/"), url, *fields, image


def _episodes(url: str, channel: ET.Element) -> Iterator[tuple]:
    (name, *_, channel_image), = _channel(url, channel)
    for item in channel.iter("item"):
        enclosure = item.find("enclosure")
        audio = None if enclosure is None else enclosure.get("url")
        if not audio:
            continue
        link = _text(item, "link")
        image = _image(item) if item.find(f"{_ITUNES}image") is not None else channel_image
        own = _text(item, "guid") or _readable(link or audio)
        yield own, name, url, _text(item, "title"), _text(item, "description"), link or audio, audio, link, _text(item, f"{_ITUNES}duration"), _text(item, "pubDate"), image


def _read(feeds: DataFrame, schema: str, records: Callable[[str, ET.Element], Iterator[tuple]]) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, xml in zip(batch["rss_url"], batch["xml"], strict=True):
                try:
                    channel = ET.fromstring(xml or "").find("channel")
                except ET.ParseError:
                    channel = None
                if channel is not None:
                    rows += records(url, channel)
            yield pd.DataFrame(rows, columns=names)

    return feeds.select("rss_url", "xml").mapInPandas(run, schema)


def channels(feeds: DataFrame) -> DataFrame:
    """One row for each feed of ``feeds`` (rss_url, xml); text that is no feed gives none."""
    return _read(feeds, _CHANNEL, _channel)


def episodes(feeds: DataFrame) -> DataFrame:
    """One row for each item with audio, named by its guid or else by its link; an item without image has its channel's."""
    return _read(feeds, _EPISODE, _episodes)


#: Fixed values of the records: what is configured for a feed beside its address.
CONFIGURED = ("website", "offered_by", "topics", "apple_podcasts_url", "google_podcasts_url")


def configured(channels: DataFrame, settings: DataFrame) -> DataFrame:
    """Channels with what is configured for their feeds: the columns CONFIGURED, null where not given, and the title from ``podcast_title`` if any.

    ``settings`` has rss_url and any of those columns; rows without a rss_url or a website configure nothing. Of several rows
    for one feed the greatest counts, so a channel stays one row. Channels without settings keep their own title.
    """
    names = [*CONFIGURED, "podcast_title"]
    given = settings.select("rss_url", *[F.col(c) if c in settings.columns else F.lit(None).cast("string").alias(c) for c in names])
    given = given.where("rss_url is not null and website is not null").groupBy("rss_url").agg(F.max(F.struct(*names)).alias("__given"))
    title = F.coalesce(F.nullif(F.col("__given.podcast_title"), F.lit("")), F.col("title"))
    rows = channels.join(given, "rss_url", "left").withColumn("title", title)
    return rows.select(*channels.columns, *[F.col(f"__given.{c}").alias(c) for c in CONFIGURED])
