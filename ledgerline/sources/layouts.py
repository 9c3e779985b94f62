"""Declared landing layouts of the eight bulk files.

Each layout is an ordered tuple of ``(column, kind)``.  Kinds say how the raw
text field is cleaned (see ``ledgerline.functions.clean``):

``s`` string as is (empty -> NULL) · ``z`` postal5 · ``y`` year4 -> SMALLINT ·
``h`` SMALLINT · ``b`` BIGINT · ``m`` DECIMAL(14,2) · ``p`` DECIMAL(7,4) ·
``d`` DATE ``%m%d%Y`` · ``D`` DATE ``%m/%d/%Y`` else ``%m%d%Y``.

Fixed values: the field order, names (including the source's own spelling
``GEN_ELECTION_PRECENT``) and member names must equal the published bulk-file
layouts, so they are stated here as data.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    name: str
    member: str  # archive member; ``{yy}`` is replaced by the two-digit cycle
    group: str  # "dimension" or "fact"
    columns: tuple[tuple[str, str], ...]

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def kind(self, column: str) -> str:
        return dict(self.columns)[column]

    def member_for(self, cycle: int) -> str:
        return self.member.replace("{yy}", str(cycle)[-2:])


def _cols(spec: str) -> tuple[tuple[str, str], ...]:
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        out.append((name, kind or "s"))
    return tuple(out)


# Published field order of each bulk file.
_CONTRIB = (
    "CMTE_ID AMNDT_IND RPT_TP TRANSACTION_PGI IMAGE_NUM TRANSACTION_TP ENTITY_TP NAME CITY STATE "
    "ZIP_CODE:z EMPLOYER OCCUPATION TRANSACTION_DT:d TRANSACTION_AMT:m OTHER_ID TRAN_ID FILE_NUM:b "
    "MEMO_CD MEMO_TEXT SUB_ID:b"
)

CM = Layout("cm", "cm.txt", "dimension", _cols(
    "CMTE_ID CMTE_NM TRES_NM CMTE_ST1 CMTE_ST2 CMTE_CITY CMTE_ST CMTE_ZIP:z CMTE_DSGN CMTE_TP "
    "CMTE_PTY_AFFILIATION CMTE_FILING_FREQ ORG_TP CONNECTED_ORG_NM CAND_ID"))

CN = Layout("cn", "cn.txt", "dimension", _cols(
    "CAND_ID CAND_NAME CAND_PTY_AFFILIATION CAND_ELECTION_YR:y CAND_OFFICE_ST CAND_OFFICE "
    "CAND_OFFICE_DISTRICT CAND_ICI CAND_STATUS CAND_PCC CAND_ST1 CAND_ST2 CAND_CITY CAND_ST CAND_ZIP:z"))

CCL = Layout("ccl", "ccl.txt", "dimension", _cols(
    "CAND_ID CAND_ELECTION_YR:y FEC_ELECTION_YR:y CMTE_ID CMTE_TP CMTE_DSGN LINKAGE_ID:b"))

WEBALL = Layout("weball", "weball{yy}.txt", "dimension", _cols(
    "CAND_ID CAND_NAME CAND_ICI PTY_CD CAND_PTY_AFFILIATION TTL_RECEIPTS:m TRANS_FROM_AUTH:m "
    "TTL_DISB:m TRANS_TO_AUTH:m COH_BOP:m COH_COP:m CAND_CONTRIB:m CAND_LOANS:m OTHER_LOANS:m "
    "CAND_LOAN_REPAY:m OTHER_LOAN_REPAY:m DEBTS_OWED_BY:m TTL_INDIV_CONTRIB:m CAND_OFFICE_ST "
    "CAND_OFFICE_DISTRICT SPEC_ELECTION PRIM_ELECTION RUN_ELECTION GEN_ELECTION "
    "GEN_ELECTION_PRECENT:p OTHER_POL_CMTE_CONTRIB:m POL_PTY_CONTRIB:m CVG_END_DT:D "
    "INDIV_REFUNDS:m CMTE_REFUNDS:m"))

INDIV = Layout("indiv", "itcont.txt", "fact", _cols(_CONTRIB))
OTH = Layout("oth", "itoth.txt", "fact", _cols(_CONTRIB))
PAS2 = Layout("pas2", "itpas2.txt", "fact", _cols(
    _CONTRIB.replace("OTHER_ID TRAN_ID", "OTHER_ID CAND_ID TRAN_ID")))

OPPEXP = Layout("oppexp", "oppexp.txt", "fact", _cols(
    "CMTE_ID AMNDT_IND RPT_YR:h RPT_TP IMAGE_NUM LINE_NUM FORM_TP_CD SCHED_TP_CD NAME CITY STATE "
    "ZIP_CODE:z TRANSACTION_DT:d TRANSACTION_AMT:m TRANSACTION_PGI PURPOSE CATEGORY CATEGORY_DESC "
    "MEMO_CD MEMO_TEXT ENTITY_TP SUB_ID:b FILE_NUM:b TRAN_ID BACK_REF_TRAN_ID"))

LAYOUTS: dict[str, Layout] = {
    lay.name: lay for lay in (CM, CN, CCL, WEBALL, INDIV, OPPEXP, OTH, PAS2)
}

# Table groups of the default coverage configuration.
DIMENSIONS = ("cm", "cn", "ccl", "weball")
FACTS = ("indiv", "oppexp", "oth", "pas2")
ALL_TABLES = DIMENSIONS + FACTS
