from featherline.functions import keys, records, text, vectors

__all__ = ["keys", "records", "text", "vectors"]
