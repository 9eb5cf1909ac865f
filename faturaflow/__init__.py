"""Purchase-invoice processing for mailboxes, as Spark DataFrame jobs."""
