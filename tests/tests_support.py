"""Rows that several test modules use."""

EVENT = {"event_type": "filing.downloaded", "schema_version": 1, "ticker": "QRY", "company_name": "QUARRY STONE PLC",
         "filing_date": "2019-02-07", "form": "10-K", "accession_number": "0000900017-19-000042",
         "local_path": "/data/a.htm", "document_url": "https://filings.invalid/q/a.htm",
         "downloaded_at": "2019-02-08T06:05:04.030201Z"}
PAGE = "<html><body><p>ITEM 1. Quarries</p><p>We cut stone. " + "Slabs and blocks. " * 10 + "</p></body></html>"
