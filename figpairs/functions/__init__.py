from figpairs.functions.text import (  # noqa: F401
    IMAGE_EXTS,
    PACKAGE_EXT,
    SHARD_SIZE,
    SPLIT_CUTS,
    SPLIT_NAMES,
    XML_EXT,
    basename,
    fmt05,
    is_image_name,
    is_xml_name,
    md5_bucket,
    nonempty_or,
    normalize_pmcid,
    parent_dir,
    py_strip,
    split_tabs,
    stem,
    with_ext,
)
