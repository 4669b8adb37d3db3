"""Writers for requests, bulk documents and reassembled files, and their result tables."""
