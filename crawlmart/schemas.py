"""Fixed schemas: responses, the bodies inside them, and the tables of the star."""

from pyspark.sql import types as T

S, L, I, B, TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# -- responses -------------------------------------------------------------------------
PAGE = _struct(page_id=L, url=S, status=I, html=S)
RESPONSE = _struct(resp_seq=L, url=S, body=S)

# -- bodies ----------------------------------------------------------------------------
AVATAR = _struct(id=S, template=S)
AUTHOR = _struct(
    uid=S, name=S, profileUrl=S, hash=S, slug=S, description=S, headline=S, avatar=AVATAR
)
CREATOR = _struct(
    uid=S, name=S, profileUrl=S, hash=S, slug=S, description=S, bio=S, avatar=AVATAR
)
POST = _struct(
    slug=S, title=S, content=S, summary=S, titleImage=S, publishedTime=S, author=AUTHOR
)
POSTS = T.ArrayType(POST)
COLUMN_INFO = _struct(
    slug=S, name=S, description=S, postsCount=S, avatar=AVATAR, creator=CREATOR
)
PAGING = _struct(is_end=B, next=S)
PAGED = _struct(paging=PAGING)
MEMBER = _struct(id=S, name=S, url_token=S, avatar_url=S, headline=S)
MEMBERS = _struct(paging=PAGING, data=T.ArrayType(MEMBER))
CONTRIBUTIONS = _struct(paging=PAGING, data=T.ArrayType(_struct(column=_struct(id=S))))
FOLLOWING = _struct(paging=PAGING, data=T.ArrayType(_struct(id=S)))
RECOMMENDATIONS = T.ArrayType(_struct(slug=S))
CLIENT_CONFIG = _struct(tokens=T.MapType(S, S))
STATE_POST = _struct(
    slug=S,
    title=S,
    content=S,
    summary=S,
    titleImage=S,
    publishedTime=S,
    author=S,
    column=_struct(slug=S),
    topics=T.ArrayType(_struct(name=S)),
)
STATE_USER = _struct(
    uid=S, name=S, profileUrl=S, hash=S, slug=S, description=S, headline=S, avatarUrl=S
)
POST_STATE = _struct(
    database=_struct(Post=T.MapType(S, STATE_POST), User=T.MapType(S, STATE_USER))
)

# -- items -----------------------------------------------------------------------------
USER_ITEM = _struct(
    zuid=S, name=S, link=S, hash=S, slug=S, description=S, headline=S, avatar=S
)
COLUMN_ITEM = _struct(name=S, link=S, hash=S, slug=S, description=S, avatar=S)

# -- tables ----------------------------------------------------------------------------
PROXY = _struct(
    id=L, create_time=TS, modify_time=TS, host=S, port=I, protocol=I, available=B
)
ARTICLE = _struct(
    id=L, create_time=TS, modify_time=TS, title=S, md5=S, content=S, summary=S, cover=S,
    link=S, token=S, keywords=S, author_id=L, belong_id=L,
)
COLUMN = _struct(
    id=L, create_time=TS, modify_time=TS, name=S, link=S, hash=S, slug=S, description=S,
    avatar=S, creator_id=L, last_update_time=TS,
)
USER = _struct(
    id=L, zuid=S, create_time=TS, modify_time=TS, name=S, link=S, hash=S, slug=S,
    description=S, headline=S, avatar=S, crawl_column=B, crawl_follow=B,
)
TAG = _struct(id=L, create_time=TS, modify_time=TS, name=S)
ARTICLE_TAG = _struct(id=L, zharticle_id=L, tag_id=L)
RANDOM_COLUMN = _struct(id=L, create_time=TS, modify_time=TS, slug=S, link=S, hash=S)
MEMBER_SET = _struct(slug=S)
