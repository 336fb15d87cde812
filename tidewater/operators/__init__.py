"""Relational building blocks: latest-per-key, surrogate keys, keyed upsert,
point-in-time joins, nesting/explode, duplicate finders, range tagging."""
