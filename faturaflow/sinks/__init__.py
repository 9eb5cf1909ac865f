"""Outbox tables: what the job hands to the ERP and to the mail sender."""
