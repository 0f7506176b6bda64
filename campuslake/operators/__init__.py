"""Pure ``DataFrame -> DataFrame`` operators; nothing in here touches storage."""
