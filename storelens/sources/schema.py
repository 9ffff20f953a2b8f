"""The declared columns of the 35 warehouse tables: type, length, NOT NULL and default."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

# Each line is a column, its type, and "not null" or "default 0" where declared.
COLUMNS = {
    "CA_PRD_RP": """
        ID_PRD_RP int not null
        ID_CLD int not null
        ID_CLD_LV int not null
        ID_CLD_PRD_SRT int not null
        ID_CLD_PRD_END int not null
        NM_PRD_RP varchar(40)
    """,
    "CO_CD_RSN": """
        CD_RSN varchar(20) not null
        CD_RSN_GRP varchar(20)
        NM_RSN varchar(40)
        DE_RC varchar(4000)
    """,
    "CO_CD_RSN_GRP": """
        CD_RSN_GRP varchar(20) not null
        NM_RSN_GRP varchar(40)
        DE_RSN_GRP varchar(4000)
    """,
    "CO_CTR_RVN_CST": """
        ID_CTR_RVN_CST int not null
        ID_BSNGP int
        ID_MRHRC_GP int
        NM_CTR_RVN_CST varchar(40)
    """,
    "CO_CVN_UOM": """
        CD_CVN_UOM_FM varchar(20) not null
        CD_CVN_UOM_TO varchar(20) not null
        MO_UOM_CVN decimal(9,2) default 0
    """,
    "CO_METAR_WTHR_CN": """
        ID_METAR_WTHR_CN char(32) not null
        MN_CLD char(2)
        YR_CLD char(4)
        TS_UNVRSL_RP_TM char(7)
        CD_ICAO char(4) not null
        CD_WTHR_CN_TYP varchar(20) not null
        DE_METAR_WTHR varchar(255)
        CD_METAR_WND_CN varchar(20)
        CD_METAR_VSBLTY varchar(20)
        CD_METAR_WTHR_CN varchar(20)
        CD_METAR_CLD_CN char(4)
        QU_METAR_TEMP_DEW_PNT varchar(20)
    """,
    "CO_ST_INV": """
        ID_ST_INV int not null
        NM_ST_INV varchar(40)
    """,
    "CO_UOM": """
        CD_UOM varchar(20) not null
        TY_UOM varchar(20)
        FL_UOM_ENG_MC int
        NM_UOM varchar(40)
        DE_UOM varchar(255)
    """,
    "DW3_DIM_APR": """
        ID_ITM char(32) not null
        TY_ITM_STK char(2)
        DE_STYL varchar(255)
        NM_STYL varchar(40)
        DE_SLH varchar(255)
        DE_FBRC varchar(255)
        CD_GND varchar(20)
        DE_PTTRN varchar(255)
        CD_APR_AG_GP varchar(20)
        CD_APR_SN varchar(20)
        DE_APR_CRE varchar(255)
        DE_FRMLTY varchar(255)
        NM_CLR varchar(40)
        DE_CLR varchar(255)
        DE_MDFR varchar(255)
        NM_AGY_CLR_LST varchar(40)
        NM_PLTE_CLR varchar(40) not null
        DE_PLTE_CLR varchar(255) not null
        CD_TB_SZ_NRF char(2)
        NM_TB_SZ varchar(40)
        DE_TYP_ACT_SZ varchar(40)
        DE_PRPTN_ACT_SZ varchar(255)
        NM_SZ_FMY varchar(40)
        DE_SZ_FMY varchar(4000)
    """,
    "DW3_DIM_BSN_UN_GEO_HIER": """
        ID_GEO_LCN char(32) not null
        ID_BSN_UN char(32) not null
        ID_GEO_SGMT_HRC int not null
        NM_BSN_UN varchar(40)
        TY_BSN_UN char(2)
        ID_BSNGP int
        ID_STE int
        CD_STE_TY varchar(20)
        CD_CLMT_TYP varchar(20)
        NM_GEO_SGMT_HRC varchar(40)
        BSN_UN_GEO_LOC_GP_ID_TREE_PTH varchar(4000)
        BSN_UN_GEO_LOC_GP_NM_PTH varchar(4000)
        BSN_UN_GEO_LOC_HRC_LVL_PTH varchar(4000)
        BSN_UN_GEO_LOC_HRC_LVL_NM_PTH varchar(4000)
    """,
    "DW3_DIM_BSNGP": """
        ID_BSNGP_FNC int not null
        ID_BSN_UN char(32) not null
        NM_BSNGP_FNC varchar(40)
        ID_BSNGP_LV int
        ID_BSNGP_PRNT int
        ID_BSNGP_CHLD int not null
        BSNGP_ID_HRC_TREE_PTH varchar(4000)
        BSNGP_HRC_LVL_PTH varchar(4000)
        BSNGP_HRC_LVL_GP_NM_PTH varchar(4000)
        BSNGP_HRC_LVL_NM_PTH varchar(4000)
        CD_BSNGP_HRC varchar(4)
    """,
    "DW3_DIM_BUSINESS_UNIT": """
        ID_BSN_UN char(32) not null
        TY_BSN_UN char(2)
        NM_BSN_UN varchar(40)
        ID_CNY_LCL int
        ID_PRTY_OPR int
        ID_STE int not null
        ID_GEO_LCN char(32)
        CD_TYP_CRDN_GEO char(2)
        CD_CRDN_VL varchar(30)
        CD_ICAO char(4)
        CD_STE_TY varchar(20)
        CD_TZ char(6)
        ID_PRTY_OPR_STE int
        A1_ADS varchar(80)
        A2_ADS varchar(80)
        A3_ADS varchar(80)
        A4_ADS varchar(80)
        CI_CNCT varchar(30)
        ID_ISO_3166_2_CY_SBDVN int
        ID_PSTL_CD char(32)
        ID_GEO_SGMT int
        DC_OPN_RT_STR date
        DC_CL_RT_STR date
        DC_RMDL_LST date
        QU_SZ_AR_SL decimal(9,2) default 0
        QU_SZ_STR decimal(9,2) default 0
    """,
    "DW3_DIM_CA_HIER": """
        ID_CLD int not null
        DC_DY_BSN date not null
        NM_CLD varchar(40)
        ID_CLD_LV_PRNT int
        ID_CLD_PRD_CHLD int
        CLD_PRD_ID_TREE_PTH varchar(4000)
        CLD_PRD_LVL_PTH varchar(4000)
        CLD_PRD_LVL_NM_PTH varchar(4000)
        CLD_PRD_NM_PTH varchar(4000)
    """,
    "DW3_DIM_CA_PRD_RP": """
        ID_PRD_RP int not null
        DC_DY_BSN date not null
        NM_PRD_RP varchar(40)
        ID_CLD int not null
        NM_CLD varchar(40)
        ID_CLD_LV int not null
        ID_CLD_PRD int not null
        CLD_PRD_ID_TREE_PTH varchar(4000)
        CLD_PRD_LVL_PTH varchar(4000)
        CLD_PRD_HRC_LVL_NM_PTH varchar(4000)
        CLD_PRD_NM_PTH varchar(4000)
    """,
    "DW3_DIM_CHNL": """
        ID_CHNL int not null
        DE_CHNL_DSCR varchar(255)
        CD_TGT_TYP varchar(20)
        CD_CNTN_ORG varchar(20)
        CD_ON_LN_OFF_LN varchar(20)
        CD_COM_MOD varchar(20)
        NM_TCH_PNT varchar(255)
        CD_PHY_DGTL varchar(20)
        CD_MGD_TYP varchar(20)
        NM_BSN_DMN varchar(255)
        NA_BSN_DMN varchar(4000)
        NM_PCS varchar(255)
        NA_PCS varchar(4000)
        DT_EF datetime
        DT_EP datetime
        NA_RMRK varchar(4000)
    """,
    "DW3_DIM_CT": """
        ID_CT int not null
        FL_ANNYMS int
        ID_CT_HSHLD char(32)
        ID_KY_CT int
        CD_PVCY_OOUT char(2)
        DT_RGSTN datetime
        ID_PRTY int not null
        CD_PRTY_TYP varchar(20)
        NM_PRS_SLN varchar(40)
        FN_PRS varchar(40)
        TY_NM_FS char(2)
        MD_PRS varchar(40)
        TY_NM_MID char(2)
        LN_PRS varchar(40)
        TY_NM_LS char(2)
        NM_PRS_SFX varchar(40)
        NM_PRS_SR varchar(40)
        NM_PRS_ML varchar(40)
        NM_PRS_OFCL varchar(40)
        ID_LGE char(4)
        TY_GND_PRS char(2)
        DC_PRS_BRT date
        CD_ANN_INCM_RNGE varchar(20)
        CD_MRTL_STS varchar(20)
        CD_RC varchar(20)
        CD_OCCPTN_TYP varchar(20)
        CD_LF_STG varchar(20)
        CD_ETHNC_TYP varchar(20)
        CD_RLGN_FMY varchar(20)
        NM_RLGN varchar(20)
        CD_EDC_LV varchar(20)
        CD_EMPLMT_STS varchar(20)
        CD_PRSNLTY_TYP varchar(20)
        CD_LFSTYL_TYP varchar(20)
        CD_PRSL_VL_TYP varchar(20)
        CD_VL_ATTD_LFSTL varchar(20)
        CD_CNS_CR_SCOR varchar(20)
        NM_CNS_CR_RTG_SV varchar(40)
        CD_DTRY_HBT_TYP varchar(20)
        CD_DSBLTY_IMPRMNT_TYP varchar(20)
        CD_ACTV_INTRST_1 varchar(20)
        CD_LSUR_PRFSL_TYP_1 varchar(20)
        CD_ACTV_INTRST_2 varchar(20)
        CD_LSUR_PRFSL_TYP_2 varchar(20)
        CD_ACTV_INTRST_3 varchar(20)
        CD_LSUR_PRFSL_TYP_3 varchar(20)
        CD_LGL_STS varchar(20)
        NM_LGL varchar(40)
        NM_TRD varchar(40)
        DC_TRMN date
        NM_JRDT_OF_INCRP varchar(255)
        DC_INCRP date
        CD_LGL_ORGN_TYP varchar(20)
        DC_FSC_YR_END date
        CD_BSN_ACTV varchar(20)
        MO_LCL_ANN_RVN decimal(16,5) default 0
        MO_GBL_ANN_RVN decimal(16,5) default 0
        DC_OPN_FR_BSN date
        DC_CLSD_FR_BSN date
        ID_DUNS_NBR char(9)
        FL_BNKRPTY int
        DC_BNKRPTY date
        DC_BNKRPTY_EMRGNC date
        CD_BNKRPTY_TYP varchar(20)
        QU_EM_CNT_LCL int
        QU_EM_CNT_GBL int
        CD_RTG_DUNN_AND_BRDST varchar(20)
        ID_LGE_PRMRY char(4)
        NA_DE_ORGN varchar(4000)
        A1_ADS varchar(80)
        A2_ADS varchar(80)
        A3_ADS varchar(80)
        A4_ADS varchar(80)
        CI_CNCT varchar(30)
        ST_CNCT char(2)
        ID_ISO_3166_2_CY_SBDVN int
        ID_GEO_SGMT int
        PH_CMPL varchar(32)
        EM_ADS_DMN_PRT varchar(80)
        EM_ADS_LOC_PRT varchar(80)
        ID_SCL_NTWRK char(32)
        NM_SCL_NTWRK varchar(40)
        ID_SCL_NTWRK_HNDL char(32)
        ID_SCL_NTWRK_USR varchar(255)
    """,
    "DW3_DIM_CT_GEO_SGMT": """
        ID_CT int not null
        ID_GEO_LCN char(32) not null
        ID_GEO_SGMT_HRC int not null
        ID_PRTY int not null
        ID_PRTY_RO_ASGMT char(32)
        SC_RO_PRTY char(2)
        CD_TYP_CNCT_MTH char(6)
        CD_TYP_CNCT_PRPS char(2)
        SC_PTY_CNCT_MTH char(2)
        ID_ADS int
        A1_ADS varchar(80)
        A2_ADS varchar(80)
        A3_ADS varchar(80)
        A4_ADS varchar(80)
        CD_ISO_3_CHR_CY char(4)
        CD_ISO_CY_PRMRY_SBDVN_ABBR_CD char(6)
        NM_ISO_CY varchar(40)
        NM_ISO_CY_PRMRY_SBDVN varchar(40)
        CI_CNCT varchar(30)
        CD_PSTL varchar(20)
        CD_PSTL_EXTN char(4)
        DE_PSTL_CD varchar(255)
        CD_TYP_CRDN_GEO char(2)
        CD_CRDN_VL varchar(30)
        NM_GEO_LCN varchar(255)
        CD_CLMT_TYP varchar(20)
        ID_GEO_SGMT_HRC_GP char(32)
        NM_GEO_SGMT_HRC varchar(40)
        IC_PRNT_HRC_LV_NMB smallint
        CT_GEO_LCN_ID_HRC_TREE_PTH varchar(4000)
        CT_GEO_LCN_HRC_LVL_PTH varchar(4000)
        CT_GEO_LCN_HRC_GP_NM_PTH varchar(4000)
        CT_GEO_LCN_LVL_NM_PTH varchar(4000)
    """,
    "DW3_DIM_CT_LYLTY": """
        ID_CT int not null
        ID_CTAC int not null
        ID_PRGM_LYLT int not null
        NM_PRGM_LYLT varchar(40)
        DE_PRGM_LYLT varchar(4000)
        CD_LYLT_PRGM_RLTV_VL char(2)
        NM_LYLT_PRGRM_TR varchar(40)
        NA_LYLT_PRGRM_TR varchar(4000)
    """,
    "DW3_DIM_GEO_HRC_SGMT": """
        ID_GEO_LCN char(32) not null
        ID_GEO_SGMT_HRC int not null
        NM_GEO_SGMT_HRC varchar(40)
        IC_PRNT_HRC_LV_NMB smallint
        ID_ST_SGMT_HRC_GP_CHLD char(32)
        ID_ST_SGMT_HRC_GP_PRNT char(32)
        GEO_LCN_ID_HRC_TREE_PTH varchar(4000)
        GEO_LCN_HRC_LVL_PTH varchar(4000)
        GEO_LCN_HRC_LVL_GP_NM_PTH varchar(4000)
        GEO_LCN_HRC_LVL_NM_PTH varchar(4000)
    """,
    "DW3_DIM_HSHLD": """
        ID_HSHLD char(32) not null
        ID_PRTY int not null
        NM_HSHLD varchar(255)
        CD_TYP_PRTY_AFLN char(2) not null
        SC_AFLN char(2)
        DT_AFLN_EF datetime
        DT_AFLN_EP datetime
        CD_INVLVMNT_TYP varchar(20)
        FL_PRCNPL_SUB_PRTY int
        ID_PRTY_PRS int
        NM_PRS_SLN varchar(40)
        FN_PRS varchar(40)
        MD_PRS varchar(40)
        NM_PRS_ML varchar(40)
    """,
    "DW3_DIM_HSHLD_CNCT": """
        ID_HSHLD char(32) not null
        CD_TYP_CNCT_MTH char(6) not null
        CD_TYP_CNCT_PRPS char(2) not null
        NM_HSHLD varchar(255)
        FL_PRCNPL_SUB_PRTY int
        ID_PRTY int not null
        NM_PRS_ML varchar(40)
        ID_PRTY_RO_ASGMT char(32) not null
        TY_RO_PRTY char(6) not null
        SC_RO_PRTY char(2)
        SC_PTY_CNCT_MTH char(2)
        DC_EF datetime
        DC_EP datetime
        ID_ADS int
        A1_ADS varchar(80)
        A2_ADS varchar(80)
        A3_ADS varchar(80)
        A4_ADS varchar(80)
        CI_CNCT varchar(30)
        ST_CNCT char(2)
        ID_PSTL_CD char(32)
        ID_EM_ADS int
        EM_ADS_DMN_PRT varchar(80)
        EML_ADS_LOC_PRT varchar(80)
        ID_PH int
        PH_CMPL varchar(32)
        ID_SCL_NTWRK_HNDL char(32)
        ID_SCL_NTWRK char(32)
        ID_SCL_NTWRK_USR varchar(255)
    """,
    "DW3_DIM_INVENTORY_LOCATION": """
        ID_LCN int not null
        ID_BSN_UN char(32) not null
        ID_STE int not null
        NM_LCN varchar(40)
        QU_SZ_LCN decimal(9,2) default 0
        LU_UOM_SZ varchar(20)
        CD_FNC char(4)
        CD_LCN_SCTY_CLS char(6)
    """,
    "DW3_DIM_ITM": """
        ID_ITM char(32) not null
        NM_ITM varchar(40)
        DE_ITM varchar(255)
        DE_ITM_LNG varchar(4000)
        TY_ITM char(4)
        ID_MRHRC_GP int
        NM_BRN varchar(40)
        DE_BRN varchar(255)
        CD_BRN_GRDG varchar(20)
        NM_SUB_BRN varchar(40)
        DE_SUB_BRN varchar(255)
        LU_ITM_USG char(2)
        LU_KT_ST char(2)
        FL_ITM_SBST_IDN int
        FL_FD_STP_ALW int
        FL_CPN_ALW_MULTY int
        FL_RTN_PRH int
        FL_ITM_WIC int
        QU_MNM_SLS_UN decimal(3,0) default 0
        QU_UN_BLK_MXM decimal(3,0) default 0
        TY_ITM_STK char(2)
        CD_UOM varchar(20)
        LU_CNT_SLS_WT_UN char(2)
        FA_PRC_UN_STK_ITM decimal(9,2) default 0
        CD_UOM_RTL_PKG_SZ varchar(20)
        TY_ENV_STK_ITM char(2)
        TY_SCTY_RQ char(2)
        TY_MTR_HZ_STK_ITM char(2)
        CP_UN_SL_LS_RCV_BS decimal(16,5) default 0
        CP_CST_NT_LS_RCV decimal(16,5) default 0
        DC_CST_EST_LS_RCV date
        LU_STYL char(4)
        CD_CLR char(4)
        ID_SZ_FMY int
        CD_SZ char(6)
        DC_AVLB_FR_SLS date
        LU_MTH_INV_ACNT char(2)
        LU_WRTY_STR_SRZ char(4)
        LU_WRTY_MF_SRZ_ITM char(4)
        DE_SZ_MF_SRZ_ITM varchar(255)
        CY_MDL_SRZ_ITM char(4)
        NM_NMB_SRZ_ITM varchar(40)
        DE_CLR_MF_SRZ_ITM varchar(255)
        URI_LNK varchar(255)
        NM_LNK_FLE varchar(255)
        CD_LNK_TYP varchar(255)
        FL_SHRBL int
        NM_ITM_TTL varchar(255)
        ID_OPR_SYS char(32)
        CD_FLE_FRMT_TYP varchar(20)
        TY_ITM_SV char(2)
        LU_TRM_SV char(2)
        CP_BS_SV_ITM decimal(16,5) default 0
        CP_NT_SV_ITM decimal(16,5) default 0
        DC_CST_EST_SV_ITM date
        TY_PR_RNT char(2)
        QU_PR_RNT decimal(3,0) default 0
        MO_DS_RNT_SV decimal(16,5) default 0
        PE_DS_RNT_SV decimal(7,4) default 0
        MO_PNTY decimal(16,5) default 0
        PE_PNTY decimal(7,4) default 0
    """,
    "DW3_DIM_MDSE_HIER": """
        ID_MRHRC_FNC int not null
        ID_ITM char(32) not null
        NM_MRHRC_FNC varchar(255)
        ID_MRHRC_LV_PRNT int
        ID_MRHRC_GP_CHLD int
        ID_MRHRC_GP_PRNT int
        MRCHRC_ID_TREE_PTH varchar(4000)
        MRHRC_LVL_PTH varchar(4000)
        MRHRC_LV_NM_PTH varchar(4000)
        MRHRC_LVL_GP_NM_PTH varchar(4000)
        CD_MRHRC_ROOT varchar(4)
        ITM_ID_NM varchar(75)
    """,
    "DW3_DIM_PROMOTION": """
        ID_PRM_OFR int not null
        ID_BSNGP int
        NM_PRM_OPR varchar(40) not null
        NM_PRM_CT varchar(40) not null
        NM_PRM_PRT varchar(40) not null
        DT_PRM_EF datetime
        DT_PRM_EP datetime
        CD_STS_PRM char(18)
        TY_UP_SELL char(2) not null
        TY_CNCRN char(2) not null
        ID_RU_PRDV int
        ID_EL_PRDV int
        DE_PRM_PRDV varchar(255)
        ID_CMPGN char(32) not null
        NM_CMPGN varchar(255)
        CD_STS_CMPGN char(2)
        NM_PRM varchar(255)
        ID_PRML_INITV int not null
        NM_PRML_INITV varchar(255)
        NA_PRML_INITV varchar(4000)
        CD_PRML_TYP varchar(20)
        DT_EF datetime
        DT_EP datetime
        CD_STS_PRML_INITV char(2)
        NM_HLDY varchar(40)
        DE_HLDY varchar(255)
        CD_RLGN_FMY varchar(20)
        NM_RLGN varchar(20)
        CD_SCLR_CLBRTN_EV varchar(20)
        CD_CY_ISO char(2)
    """,
    "DW3_DIM_ST_ASCTN_RTL_TRN_CA": """
        ID_TRN char(32) not null
        IC_LN_ITM smallint not null
        ID_CLD int not null
        DC_DY_BSN date not null
    """,
    "DW3_DIM_ST_ASCTN_RTL_TRN_RP": """
        ID_TRN char(32) not null
        IC_LN_ITM smallint not null
        ID_PRD_RP int not null
        DC_DY_BSN date not null
    """,
    "DW3_FACT_CT_LYLTY_BEHAVIOR": """
        ID_TRN char(32) not null
        IC_LN_ITM smallint not null
        ID_BSN_UN char(32) not null
        DC_DY_BSN date not null
        ID_WS char(32) not null
        ID_OPR char(32) not null
        FL_CNCL int
        FL_VD int
        FL_SPN int
        FL_TRG_TRN int
        ID_CT int
        ID_CHNL int
        CD_RTL_SHPPG_TRP_TYP varchar(20)
        QU_UN_RTL_TRN decimal(7,0) default 0
        ID_RPSTY_TND int
        CD_CNY_ISO_4217 int
        TR_LTM_RDM_ID_PRGM_LYLT int
        TR_LTM_RDM_ID_CTAC int
        TR_LTM_RDM_IC_MDFR_RT_PRC smallint
        TR_LTM_RDM_ID_PDT_PRM decimal(16,5) default 0
        TR_LTM_RDM_QU_PNT_RDMD int
        TR_LTM_RDM_ID_LYLT_PNT_ERN_DRVN_RU int
        TR_LTM_RDM_ID_PRM_OFR int
        TR_LTM_RDM_ID_PRML_INITV int
        TR_LTM_RDM_ID_RU_PRDV int
        TR_LTM_RDM_ID_EL_PRDV int
        TR_LTM_RDM_PE_MDFR_RT_PRC decimal(7,4) default 0
        TR_LTM_RDM_MO_MDFR_RT_PRC decimal(16,5) default 0
        TR_LTM_RDM_MO_PRV_PRC decimal(7,2) default 0
        TR_LTM_RDM_CD_MTH_CLC char(4)
        TR_LTM_RDM_CD_MTH_ADJT char(2)
        TR_LTM_RDM_MO_NW_PRC decimal(7,2) default 0
        TR_LTM_RDM_CD_MDF_BNFT char(4)
        TR_LTM_RDM_DE_MDFR_RTL_PRC varchar(255)
        TR_RDM_ID_PRM_OFR int
        TR_RDM_ID_PRML_INITV int
        TR_RDM_ID_RU_PRDV int
        TR_RDM_ID_EL_PRDV int
        TR_RDM_PE_MDF decimal(7,4) default 0
        TR_RDM_MO_MDF decimal(16,5) default 0
        TR_RDM_MO_PRC_MDFN_BS_AMT decimal(7,2) default 0
        TR_RDM_DE_TR_LTM_MDF varchar(255)
        TR_LTM_ERN_ID_PRGM_LYLT int
        TR_LTM_ERN_ID_CTAC int
        TR_LTM_ERN_QU_PNT_ERN int
        TR_LTM_ERN_ID_LYLT_PNT_ERN_DRVN_RU int
        TR_LTM_ERN_ID_LYLT_PNT_ERN_EL_RU int
        TR_LTM_ERN_CD_LYLT_PRGM_RLTV_VL char(2)
        PRML_QU_RWD_PNT_ERN int
        PRML_ID_PRM_OFR int
        PRML_ID_RU_PRDV int
        PRML_ID_EL_PRDV int
        PRML_ID_PRML_INITV int
    """,
    "DW3_FACT_INVENTORY": """
        ID_ITM char(32) not null
        ID_BSN_UN char(32) not null
        ID_LCN int not null
        ID_ST_INV int not null
        ID_CTR_RVN_CST int not null
        ID_PRD_RP int not null
        ID_PRD_RP_CLD int not null
        DC_INV_FS_RCPT date
        DC_INV_LS_RCPT date
        MO_UN_RTL decimal(7,2) not null default 0
        MO_UN_CST decimal(16,5) default 0
        QU_ON_ORD_CNT decimal(38,2)
        MO_ON_ORD_CST decimal(38,7)
        MO_ON_ORD_RTL_AMT decimal(38,4)
        QU_INTRST_CNT decimal(38,2)
        MO_INTRST_CST decimal(38,7)
        MO_INTRST_RTL decimal(38,4)
        CD_MKD_CYCL char(4)
        QU_DSC_ITM decimal(9,2) default 0
        QU_BGN decimal(9,2) not null default 0
        QU_RCV decimal(9,2) not null default 0
        QU_TSF_IN decimal(9,2) not null default 0
        QU_TSF_OT decimal(9,2) not null default 0
        QU_ADJT decimal(9,2) not null default 0
        QU_RTN decimal(9,2) not null default 0
        QU_SLS decimal(9,2) not null default 0
        QU_RTV decimal(9,2) not null default 0
        QU_END decimal(9,2) not null default 0
        CP_UN_AV_WT_BGN decimal(16,5) not null default 0
        CP_UN_AV_WT_END decimal(16,5) not null default 0
        TC_RCV_CM decimal(16,5) not null default 0
        TP_RCV decimal(16,5) not null default 0
        MO_VL_BGN decimal(16,5) not null default 0
        MO_MKN_CM decimal(16,5) not null default 0
        PE_MKN_CM decimal(7,4) not null default 0
        TP_SLS_GS_CM decimal(16,5) not null default 0
        TP_RTN decimal(16,5) not null default 0
        MO_TSF_IN_CM decimal(16,5) not null default 0
        MO_TSF_OT_CM decimal(16,5) not null default 0
        TP_RTN_TO_VN decimal(16,5) not null default 0
        MO_ADJT_RT_CM decimal(16,5) not null default 0
        MO_MKD_PRN_CM decimal(16,5) not null default 0
        MO_MKD_TMP_CM decimal(16,5) not null default 0
        MO_MKP_PRN_CM decimal(16,5) not null default 0
        MO_MKP_TMP_CM decimal(16,5) not null default 0
        MO_DSC_EM_CM decimal(16,5) not null default 0
        MO_DPC_DM_CM_ITM decimal(16,5) not null default 0
        MO_DPC_OT_OF_DT decimal(16,5) not null default 0
        MO_VL_END decimal(16,5) default 0
    """,
    "DW3_FACT_SALE_RTN_BEHAVIOR": """
        ID_TRN char(32) not null
        IC_LN_ITM smallint not null
        ID_BSN_UN char(32) not null
        ID_LCN int
        DC_DY_BSN date not null
        ID_WS char(32) not null
        ID_OPR char(32) not null
        FL_CNCL int
        FL_VD int
        FL_SPN int
        FL_TRG_TRN int
        ID_METAR_WTHR_CN char(32)
        ID_METAR_WTHR_FRCST char(32)
        ID_CT int
        ID_CHNL int
        CD_RTL_SHPPG_TRP_TYP varchar(20)
        QU_UN_RTL_TRN decimal(7,0) default 0
        ID_RPSTY_TND int
        CD_CNY_ISO_4217 char(3)
        ID_ITM char(32)
        ID_ITM_PS_QFR int
        ID_ITM_PS varchar(14)
        ID_ITM_UN_TRC char(32)
        MO_PRC_REG decimal(7,2) default 0
        UN_UPRQY_REG decimal(9,2) default 0
        UN_UPRQY_ACT decimal(9,2) default 0
        QU_ITM_LM_RTN_SLS decimal(9,2) default 0
        QU_UN decimal(9,2) default 0
        MO_EXTND decimal(16,5) default 0
        MO_DSC_UN decimal(7,2) default 0
        MO_DSC_UN_EXT decimal(7,2) default 0
        LU_PRC_RT_DRVN char(4)
        LU_ACTN_CD char(2)
        CD_RSN varchar(20)
        CP_UN decimal(16,5) default 0
        UN_UPRQY decimal(9,2) default 0
        RP_MSRP decimal(7,2) default 0
        UN_MSRP_UPRQY decimal(9,2) default 0
        CP_INV decimal(16,5) default 0
        UN_INV_UPRQY decimal(9,2) default 0
        ID_STR_ISSG char(32)
        ID_NMB_SRZ_GF_CF char(32)
        ID_RU_PRDV int
        ID_EL_PRDV int
        FL_PRRT int
        PE_MDF decimal(7,4) default 0
        MO_MDF decimal(16,5) default 0
        MO_PRC_MDFN_BS_AMT decimal(7,2) default 0
        DE_TR_LTM_MDF varchar(255)
        MO_TRN_LVL_DSCNT decimal(16,5)
        ID_PRM_OFR_1 int
        ID_PRML_INITV_1 int
        ID_RU_PRDV_1 int
        ID_EL_PRDV_1 int
        MO_PRV_PRC_1 decimal(7,2) default 0
        PE_MDFR_RT_PRC_1 decimal(7,4) default 0
        MO_MDFR_RT_PRC_1 decimal(16,5) default 0
        CD_MTH_CLC_1 char(4)
        CD_MTH_ADJT_1 char(2)
        MO_NW_PRC_1 decimal(7,2) default 0
        CD_MDF_BNFT_1 char(4)
        DE_MDFR_RTL_PRC_1 varchar(255)
        PE_TR_LTM_MDF_PRRT_1 decimal(7,4) default 0
        CD_RSN_1 varchar(20)
        ID_PRM_OFR_2 int
        ID_PRML_INITV_2 int
        ID_RU_PRDV_2 int
        ID_EL_PRDV_2 int
        MO_PRV_PRC_2 decimal(7,2) default 0
        PE_MDFR_RT_PRC_2 decimal(7,4) default 0
        MO_MDFR_RT_PRC_2 decimal(16,5) default 0
        CD_MTH_CLC_2 char(4)
        CD_MTH_ADJT_2 char(2)
        MO_NW_PRC_2 decimal(7,2) default 0
        CD_MDF_BNFT_2 char(4)
        DE_MDFR_RTL_PRC_2 varchar(255)
        PE_TR_LTM_MDF_PRRT_2 decimal(7,4) default 0
        CD_RSN_2 varchar(20)
        ID_PRM_OFR_3 int
        ID_PRML_INITV_3 int
        ID_RU_PRDV_3 int
        ID_EL_PRDV_3 int
        MO_PRV_PRC_3 decimal(7,2) default 0
        PE_MDFR_RT_PRC_3 decimal(7,4) default 0
        MO_MDFR_RT_PRC_3 decimal(16,5) default 0
        CD_MTH_CLC_3 char(4)
        CD_MTH_ADJT_3 char(2)
        MO_NW_PRC_3 decimal(7,2) default 0
        CD_MDF_BNFT_3 char(4)
        DE_MDFR_RTL_PRC_3 varchar(255)
        PE_TR_LTM_MDF_PRRT_3 decimal(7,4) default 0
        CD_RSN_3 varchar(20)
        ID_PRM_OFR_4 int
        ID_PRML_INITV_4 int
        ID_RU_PRDV_4 int
        ID_EL_PRDV_4 int
        MO_PRV_PRC_4 decimal(7,2) default 0
        PE_MDFR_RT_PRC_4 decimal(7,4) default 0
        MO_MDFR_RT_PRC_4 decimal(16,5) default 0
        CD_MTH_CLC_4 char(4)
        CD_MTH_ADJT_4 char(2)
        MO_NW_PRC_4 decimal(7,2) default 0
        CD_MDF_BNFT_4 char(4)
        DE_MDFR_RTL_PRC_4 varchar(255)
        PE_TR_LTM_MDF_PRRT_4 decimal(7,4) default 0
        CD_RSN_4 varchar(20)
        ID_PRM_OFR_5 int
        ID_PRML_INITV_5 int
        ID_RU_PRDV_5 int
        ID_EL_PRDV_5 int
        MO_PRV_PRC_5 decimal(7,2) default 0
        PE_MDFR_RT_PRC_5 decimal(7,4) default 0
        MO_MDFR_RT_PRC_5 decimal(16,5) default 0
        CD_MTH_CLC_5 char(4)
        CD_MTH_ADJT_5 char(2)
        MO_NW_PRC_5 decimal(7,2) default 0
        CD_MDF_BNFT_5 char(4)
        DE_MDFR_RTL_PRC_5 varchar(255)
        PE_TR_LTM_MDF_PRRT_5 decimal(7,4) default 0
        CD_RSN_5 varchar(20)
    """,
    "DW3_FACT_SMP_CR_DB_CRD_SPND": """
        ID_CT_RP_PRD_SPND int not null
        ID_PRD_RP int not null
        ID_CT int not null
        ID_TND_MD_COSPNSR char(32)
        TY_TND varchar(20)
        MO_CR_DB_TOT decimal(16,5) not null default 0
        ID_TND_MD_BRN char(32)
        ID_PYM_SV_PVR char(32)
        ID_ISSR_TND_CRD char(6)
        TY_CRD char(6)
        NM_CRD_HLD varchar(40)
        DC_EP_CRD char(4)
    """,
    "DW3_FACT_TENDER_BEHAVIOR": """
        ID_TRN char(32) not null
        IC_LN_ITM smallint not null
        ID_BSN_UN char(32) not null
        DC_DY_BSN date not null
        ID_WS char(32) not null
        ID_OPR char(32) not null
        FL_CNCL int
        FL_VD int
        FL_SPN int
        FL_TRG_TRN int
        ID_CT int
        ID_CHNL int
        CD_RTL_SHPPG_TRP_TYP varchar(20)
        QU_UN_RTL_TRN decimal(7,0) default 0
        ID_RPSTY_TND int
        CD_CNY_ISO_4217 char(3)
        TY_TND varchar(20)
        FL_CO_PAY int
        MO_TRN_AMT decimal(7,2) not null default 0
        CD_CNY_ISO_4217_TND char(3)
        TND_DNM_ID int
        TND_DNM_QU decimal(9,2) default 0
        CD_CNY_ISO_4217_LCL char(3)
        MO_RT_TO_BUY decimal(14,9)
        MO_RT_TO_SL decimal(14,9)
        MO_FE_SV_EXC decimal(16,5) default 0
        DC_RT_EXC_EF date
        DC_RT_EXC_EP date
        CSH_MO_TRN_AMT decimal(7,2) default 0
        CSH_MO_FRG_CY decimal(7,2) default 0
        CSH_MO_RTE_EXC decimal(16,5) default 0
        CSH_MO_ITM_LN_TND decimal(16,5) default 0
        CHG_MO_TRN_AMT decimal(7,2) default 0
        CHG_MO_FRG_CY decimal(7,2) default 0
        CHG_MO_RTE_EXC decimal(16,5) default 0
        CHG_MO_ITM_LN_TND decimal(16,5) default 0
        CHK_MO_TRN_AMT decimal(7,2) default 0
        CHK_MO_FRG_CY decimal(7,2) default 0
        CHK_MO_RTE_EXC decimal(16,5) default 0
        CHK_MO_ITM_LN_TND decimal(16,5) default 0
        CHK_ID_TND_MD_BRN char(32)
        ID_BK_CHK int
        ID_ACNT_CHK int
        ID_ADJN_CHK char(4)
        ID_CRD_CHK varchar(40)
        CRDB_MO_TRN_AMT decimal(7,2) default 0
        CRDB_MO_FRG_CY decimal(7,2) default 0
        CRDB_MO_RTE_EXC decimal(16,5) default 0
        CRDB_MO_ITM_LN_TND decimal(16,5) default 0
        CRDB_ID_TND_MD_BRN char(32)
        CRDB_TY_CRD char(6)
        CRDB_ID_ISSR_TND_CRD char(6)
        LU_ADJN_CRDB char(6)
        CPN_MO_TRN_AMT decimal(7,2) default 0
        CPN_MO_FRG_CY decimal(7,2) default 0
        CPN_MO_RTE_EXC decimal(16,5) default 0
        CPN_MO_ITM_LN_TND decimal(16,5) default 0
        CPN_IC_LN_ITM_VLD smallint
        CPN_ID_MF int
        CPN_FC_FMY_MF char(3)
        CPN_LU_CPN_PRM char(6)
        CPN_DC_EP varchar(20)
        CPN_QY decimal(9,2) default 0
        CPN_TY char(4)
        GF_CF_MO_TRN_AMT decimal(7,2) default 0
        GF_CF_MO_FRG_CY decimal(7,2) default 0
        GF_CF_MO_RTE_EXC decimal(16,5) default 0
        GF_CF_MO_ITM_LN_TND decimal(16,5) default 0
        GF_CF_ID_STR_ISSG char(32)
        GF_CF_ID_NMB_SRZ_GF_CF char(32)
        GF_CF_MO_UNSP decimal(16,5) default 0
        CTAC_MO_TRN_AMT decimal(7,2) default 0
        CTAC_MO_FRG_CY decimal(7,2) default 0
        CTAC_MO_RTE_EXC decimal(16,5) default 0
        CTAC_MO_ITM_LN_TND decimal(16,5) default 0
        CTAC_ID_CTAC int
        CTAC_TY_CTAC char(2)
        CTAC_CD_CR_STS varchar(20)
        CTAC_ID_INVC int
        CTAC_ID_CT_RPS int
        AI_ACNT_CT_CRD varchar(20)
        TRADEIN_MO_TRN_AMT decimal(7,2) default 0
        TRADEIN_MO_FRG_CY decimal(7,2) default 0
        TRADEIN_MO_RTE_EXC decimal(16,5) default 0
        TRADEIN_MO_ITM_LN_TND decimal(16,5) default 0
        TRADEIN_TY_TRD_IN char(2)
        EBT_MO_TRN_AMT decimal(7,2) default 0
        EBT_MO_FRG_CY decimal(7,2) default 0
        EBT_MO_RTE_EXC decimal(16,5) default 0
        EBT_MO_ITM_LN_TND decimal(16,5) default 0
        EBT_ID_FDL varchar(40)
        EBT_UN_SRZ varchar(40)
        EBT_MO_CHG decimal(7,2) default 0
    """,
    "DW3_STRD_SMRY_BSN_UN_QTRLY_NET": """
        ID_BSN_UN char(32) not null
        NRF_454_YR_QTR varchar(255)
        MO_BSN_UN_QTR_NET_SLS decimal(16,5) not null default 0
        MO_BSN_UN_QTR_NET_MRGN decimal(16,5) not null default 0
    """,
    "DW3_STRD_SMRY_CT_SLSRTN": """
        ID_CT char(32) not null
        ID_TRN char(32) not null
        ID_BSN_UN char(32) not null
        DC_DY_BSN date not null
        ID_CHNL int not null
        QU_LN_ITM int
        MO_NT_SLS decimal(16,5) not null default 0
        QU_ITM_SLD decimal(3,0) not null default 0
        QU_BLK_ITM_SLD decimal(3,0) not null default 0
        MO_COGS decimal(16,5) not null default 0
        MO_NET_MRGN decimal(16,5) not null default 0
    """,
    "DW3_STRD_SMRY_CT_TNDR": """
        ID_CT int not null
        DC_DY_BSN date not null
        ID_BSN_UN char(32) not null
        ID_CHNL int not null
        ID_TRN char(32) not null
        TY_TND varchar(20) not null
        MO_TRN_ALL_TNDR_APPLD decimal(16,5) not null default 0
        CASH_TNDR_LN_ITM_COUNT int
        CHECK_TNDR_LN_ITM_COUNT int
        CRDB_TNDR_LN_ITM_COUNT int
        CPN_TNDR_LN_ITM_COUNT int
        STRD_VL_LN_ITM_COUNT int
        CT_ACT_LN_ITM_COUNT int
        TRADEIN_LN_ITM_COUNT int
        EBT_LN_ITM_COUNT int
        MO_CSH_TRN_APPLD decimal(16,5) not null default 0
        MO_CHK_TRN_TOT_APPLD decimal(16,5) not null default 0
        MO_DBCR_TRN_TOT_APPLD decimal(16,5) not null default 0
        MO_CPN_TRN_TOT_APPLD decimal(16,5) not null default 0
        MO_GF_CF_TRN_TOT_APPLD decimal(16,5) not null default 0
        MO_CTAC_TRN_TOT_APPLD decimal(16,5) not null default 0
        MO_TRADEIN_TRN_TOT_APPLD decimal(16,5) not null default 0
        MO_EBT_TRN_TOT_APPLD decimal(16,5) not null default 0
    """,
}


class Declared(NamedTuple):
    """One declared column."""

    name: str
    type: str
    required: bool
    zero: bool

    @property
    def length(self) -> int | None:
        """Declared length of a text column."""
        found = re.fullmatch(r"(?:var)?char\((\d+)\)", self.type)
        return int(found[1]) if found else None

    @property
    def padded(self) -> bool:
        return self.type.startswith("char")

    @property
    def spark_type(self) -> str:
        """Whole numbers but flags take 64 bits: 32 do not hold every customer of a large chain."""
        if self.length is not None:
            return "string"
        if self.type == "int":
            return "int" if self.name.startswith("FL_") else "bigint"
        return {"datetime": "timestamp_ntz"}.get(self.type, self.type)


@lru_cache(maxsize=None)
def declared(table: str) -> dict[str, Declared]:
    """Columns of a table by name, in declared order."""
    columns = {}
    for line in COLUMNS[table].strip().splitlines():
        name, kind, *rest = line.split()
        flags = " ".join(rest)
        columns[name] = Declared(name, kind, "not null" in flags, "default 0" in flags)
    return columns
